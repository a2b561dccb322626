"""Text, colour and duration formats as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def duration(seconds: Column) -> Column:
    """1h02m, 3m04s, 5s; `--` for null, infinite and negative values. Halves round up."""
    whole = F.floor(seconds + 0.5).cast("long")
    h, m, s = F.floor(whole / 3600), F.floor(whole % 3600 / 60), whole % 60
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    said = F.when(h > 0, F.concat(h.cast("string"), F.lit("h"), two(m), F.lit("m"))).when(m > 0, F.concat(m.cast("string"), F.lit("m"), two(s), F.lit("s"))).otherwise(F.concat(s.cast("string"), F.lit("s")))
    bad = seconds.isNull() | F.isnan(seconds) | (seconds < 0) | (seconds == float("inf"))
    return F.when(bad, "--").otherwise(said)


def fraction(done: Column, total: Column) -> Column:
    return F.when(total > 0, done / total).otherwise(1.0)


def percent(done: Column, total: Column) -> Column:
    return F.floor(fraction(done, total) * 100).cast("int")


def bar(frac: Column, width: int = 24) -> Column:
    filled = F.floor(frac * width + 0.5).cast("int")
    return F.concat(F.repeat(F.lit("█"), filled), F.repeat(F.lit("░"), F.lit(width) - filled))


def hex_byte(text: Column, at: int) -> Column:
    return F.conv(F.substring(text, at, 2), 16, 10).cast("int")


def plain_number(x: Column) -> Column:
    """A double without a trailing `.0`."""
    return F.regexp_replace(x.cast("string"), r"\.0$", "")


def colour(code: Column) -> Column:
    """`#RRGGBB` or `#RRGGBBAA` as `r,g,b,a,rgb:r,g,b,a`, bytes then shares of one."""
    digits = F.regexp_replace(code, "^#", "")
    r, g, b = (hex_byte(digits, i) for i in (1, 3, 5))
    a = F.when(F.length(digits) >= 8, hex_byte(digits, 7)).otherwise(255)
    shares = [plain_number(x / 255) for x in (r, g, b, a)]
    return F.concat(F.concat_ws(",", *(x.cast("string") for x in (r, g, b, a))), F.lit(",rgb:"), F.concat_ws(",", *shares))


def block_id(z: Column, bx: Column, by: Column) -> Column:
    return F.format_string("z%d_%d_%d", z, bx, by)


def cell_key(lat: Column, lon: Column) -> Column:
    return F.concat_ws(",", lat.cast("string"), lon.cast("string"))


def plural(n: Column, stem: str) -> Column:
    """entry / entries, by the number."""
    return F.concat(n.cast("string"), F.lit(f" {stem}"), F.when(n == 1, "y").otherwise("ies"))


def iso_millis(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def listing_url(base: str, params: dict[str, Column]) -> Column:
    """A query url with encoded parameters, in the order given; null ones are left out."""
    said = F.concat_ws("&", *(F.when(v.isNotNull(), F.concat(F.lit(k + "="), F.url_encode(v))) for k, v in params.items()))
    return F.concat(F.lit(base + "?"), said)


def exit_reason(code: Column, signal: Column) -> Column:
    """How a task ended: killed (with the usual cause), another signal, or its code."""
    return F.when(signal == "SIGKILL", "killed by SIGKILL (out of memory?)").when(signal.isNotNull(), F.concat(F.lit("killed by "), signal)).otherwise(F.concat(F.lit("exited with code "), code.cast("string")))


def band_letter(i: Column) -> Column:
    """A, B, C ... for 0, 1, 2 ..."""
    return F.chr(i + 65)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dir_name(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def lines(whole: Column) -> Column:
    """The lines of a text, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(whole, "\r?\n"), lambda x: F.trim(x)), lambda x: x != "")


def buckets_of(json: Column) -> Column:
    """bands[0].histogram.buckets of a JSON text; an empty list where any part is missing."""
    return F.coalesce(F.from_json(F.get_json_object(json, "$.bands[0].histogram.buckets"), "array<bigint>"), F.array().cast("array<bigint>"))
