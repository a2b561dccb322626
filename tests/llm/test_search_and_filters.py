"""Top-k search, URL filter, language identification and toxicity."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.llm import beta, exact_topk, language_id, toxicity, url_filter


def brute_topk(vectors, k):
    clean = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v)]
    asked = {}
    for i, v in clean:
        if i % 20 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in clean if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard,block", [(8192, 4096), (16, 3)])
def test_topk(spark, shard, block):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.013, 0.5, 1.0]) for _ in range(4)]) for i in range(130)]
    rows += [(200, None), (220, [None, 1.0, 1.0, 1.0]), (240, [float("nan"), 1.0, 1.0, 1.0]), (None, [1.0] * 4), (260, [float("inf")] * 4), (3, rows[3][1]), (280, [1.0, 2.0]), (7, [0.5, 0.5]), (300, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit("extra") for c in ("id", "v", "n", "shard", "block", "score", "rank", "node")})
    got = exact_topk.search(exact_topk.quantised(df), F.col("id") % 20 == 0, block=block, shard=shard, fan_in=2)
    assert sorted(map(tuple, got.collect())) == brute_topk(rows, 20)


def test_topk_of_large_values_is_exact(spark):
    rows = [(0, [3e14, -2e14]), (1, [1e14, 1.0]), (2, [1e14, 2.0]), (3, [-5e13, 7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in exact_topk.top_k(df).orderBy("rank").collect()]
    exact = [(i, max(-(2**63), min(2**63 - 1, sum(int(np.floor(64 * a)) * int(np.floor(64 * b)) for a, b in zip(rows[0][1], rows[i][1], strict=True))))) for i in (1, 2, 3)]
    assert got == sorted(exact, key=lambda x: (-x[1], x[0]))


def test_topk_of_nothing(spark):
    assert exact_topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>, extra int")).collect() == []


URLS = [
    ("http://Example.ORG/es/a?x=/fr/", "example.org", "/es/a", "example.org/es/", "block"),
    ("https://m.example.org/en/1#t", "m.example.org", "/en/1", "example.org/en/1", "block"),
    ("https://other.org/x", "other.org", "/x", "org/", "allow"),
    ("https://notorg/x", "notorg", "/x", None, "allow"),
    ("http://a.com/de/1", "a.com", "/de/1", "com/de/", "block"),
    ("http://a.com/fr/1", "a.com", "/fr/1", "com/fr/", "allow"),
    ("http://a.org", "a.org", "", None, "allow"),
    ("ftp://a.org?p://b/", "a.org", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
]


def test_rules_and_parts(spark):
    pages = spark.createDataFrame([(i, u[0], "bad") for i, u in enumerate(URLS)] * 2 + [(None, "http://x.net/", "bad")], "page_id long, url string, labelled string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = url_filter.judge_pages(pages, labels).collect()
    assert len(rows) == 2 * len(URLS) + 1
    for r in rows:
        if r.page_id is not None:
            assert (r.host, r.path, r.rule, r.verdict) == URLS[r.page_id][1:]


def test_bad_hosts_are_blocked_and_small_samples_are_shrunk(spark):
    urls = [f"http://bad.site.net/{i}" for i in range(200)] + [f"http://good{i % 20}.fine.net/{i}" for i in range(400)] + ["http://once.fine.net/1"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    outcomes = spark.createDataFrame([(i, int(u.startswith("http://bad") or "once" in u)) for i, u in enumerate(urls)], "page_id long, bad int")
    verdicts = {r.host: r.verdict for r in url_filter.judge(pages, outcomes).collect()}
    assert verdicts["bad.site.net"] == "block" and verdicts["once.fine.net"] == "allow" and verdicts["good1.fine.net"] == "allow"


def run_sql(tables):
    import duckdb

    from rasterloom.llm.oracles import OP3

    c = duckdb.connect()
    for name, df in tables.items():
        c.register(name, df.toPandas())
    found = c.execute(OP3)
    names = [d[0] for d in found.description]
    return sorted(tuple(zip(names, r, strict=True)) for r in found.fetchall())


def test_reputation_decides_pages_of_the_tables(spark):
    """Hosts whose pages are labelled bad are blocked, by host and by domain; ports belong to the host, addresses share no domain."""
    urls = [f"http://{h}/{i}" for i, h in enumerate(["bad.co.uk", "bad.co.uk:8080", "x.bad.co.uk"] * 60 + ["fine.co.uk", "10.0.0.1", "10.0.0.2:90", "good.net", "also.net"] * 60)]
    urls += ["http://new.bad.co.uk/", "http://11.0.0.1/", "http://[::1]:80/", "http://user@good.net/", "http://10.0.0.1:81/" + "long" * 50_000, "http://bad.co.uk/en/1"]
    bad = lambda u: int("bad.co" in u or "10.0.0.1/" in u)
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, 1, bad(u)) for i, u in enumerate(urls[:480])], "doc_id long, quality int, toxic int")
    got = url_filter.judge_pages(pages, labels).collect()
    verdicts = {r.host: r.verdict for r in got}
    assert {h for h, v in verdicts.items() if v == "block"} == {"bad.co.uk", "bad.co.uk:8080", "x.bad.co.uk", "new.bad.co.uk", "10.0.0.1", "10.0.0.1:81"}
    rows = sorted(tuple((c, r[c]) for c in ("page_id", "host", "path", "rule", "verdict", "labelled", "bad")) for r in got)
    assert rows == run_sql({"pages": pages, "labels": labels})


def test_registered_domains(spark):
    names = spark.createDataFrame([("a.b.co.uk",), ("co.uk",), ("x.y.z.kobe.jp",), ("",), ("com",), ("1.2.3.4",), ("w.e.d.c.b.a.net",)], "name string")
    suffixes = spark.createDataFrame([("co.uk",), ("kobe.jp",), ("z.kobe.jp",)], "suffix string")
    got = {r.name: (r.domain, r.suffix) for r in url_filter.domains(names, suffixes).collect()}
    assert got == {"a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.y.z.kobe.jp": ("y.z.kobe.jp", "z.kobe.jp"), "": ("", ""), "com": ("com", "com"), "1.2.3.4": ("1.2.3.4", "[]"), "w.e.d.c.b.a.net": ("a.net", "net")}


def test_a_tie_between_rules_is_blocked(spark):
    pages = spark.createDataFrame([(1, "http://a.b.com/x")], "page_id long, url string")
    rules = [("allow", "b.com", "/x"), ("block", "b.com", "/x")]
    assert [r.verdict for r in url_filter.judge(pages, spark.createDataFrame([], "page_id long, bad int"), rules).collect()] == ["block"]


def beta_quantile(a, b, p):
    """By bisection over a sum of the density on a fine grid of angles."""
    import math

    x = (np.arange(400_000) + 0.5) * (np.pi / 2 / 400_000)
    log = (2 * a - 1) * np.log(np.sin(x)) + (2 * b - 1) * np.log(np.cos(x)) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    total = np.cumsum(np.exp(log) * 2 * np.pi / 2 / 400_000)
    i = int(np.searchsorted(total, p))
    before = total[i - 1] if i else 0.0
    return math.sin(x[i] + ((p - before) / (total[i] - before) - 0.5) * np.pi / 2 / 400_000) ** 2


def test_beta_quantiles(spark):
    cases = [(float(a), float(b)) for a in (0.5, 1, 2.5, 17, 400, 1900, 2500, 90_000) for b in (0.5, 1, 3, 40, 999, 2100, 80_000)]
    df = spark.createDataFrame(cases, "a double, b double")
    for level in (0.05, 0.5):
        for r in df.select("a", "b", beta.quantile(F.col("a"), F.col("b"), level).alias("q")).collect():
            assert abs(r.q - beta_quantile(r.a, r.b, level)) < 1e-6, r


def test_no_pages(spark):
    pages, labels = spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert url_filter.judge_pages(pages, labels).collect() == []


def plain_parse(text, sample):
    """Phrases of a text: repeatedly the longest prefix that the sample holds, or one symbol, which counts twice."""
    n, at = 0, 0
    while at < len(text):
        size = next((k for k in (64, 16, 4) if at + k <= len(text) and text[at : at + k] in sample), 0)
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        at += max(1, size)
        n += 1 if size else 2
    return n


def test_phrases_equal_plain_parsing():
    samples = {"aa": "the cat sat on the mat and ate", "bb": "le chat était sur la natte et mangea"}
    parser = language_id.Parser(samples)
    texts = ["the chat sat", "zzz the", "Était-ce  LE chat?", "", "12", "q", "the cat sat on the mat and ate" * 3]
    phrases, symbols = parser.parse(texts)
    for i, t in enumerate(texts):
        squeezed = language_id.squeeze(t)
        body = t.lower()
        kept = "".join(c if c.isalpha() else " " for c in body)
        while "  " in kept:
            kept = kept.replace("  ", " ")
        kept = kept.removeprefix(" ")
        for j, name in enumerate(parser.names):
            assert phrases[i, j] == (plain_parse(kept, language_id.squeeze(samples[name])) if squeezed or kept else 0)
        assert (symbols[i] > 0) == any(c.isalpha() for c in t)


@pytest.mark.parametrize("lane", [1, 7, 512, 1 << 20])
def test_phrases_of_long_texts_are_those_of_plain_parsing(lane):
    """Texts of over 5,000 symbols, texts of the samples themselves, one letter repeated, many lanes out of step."""
    rng = random.Random(8)
    words = ["the", "cat", "sat", "aa", "aaaa", "mat", "über", "x", "是的", "不"]
    samples = {"aa": " ".join(rng.choice(words) for _ in range(500)) + " " + "a" * 37, "bb": " ".join(rng.choice(words[:4]) for _ in range(300)), "cc": "q"}
    texts = [" ".join(rng.choice(words) for _ in range(2500)), "a" * 6001, "ab" * 3000, samples["aa"] * 2, "", "the", " ".join(["cat"] * 1500), "z" * 600, "是" * 700]
    if lane == 1:
        texts = [t[:900].strip() for t in texts]
    parser = language_id.Parser(samples, max_symbols=8, lane=lane)
    phrases, _ = parser.parse(texts)
    for i, t in enumerate(texts):
        for j, name in enumerate(parser.names):
            assert phrases[i, j] == plain_parse(language_id.squeeze(t), language_id.squeeze(samples[name]))


def test_scripts_of_many_letters(docs_of):
    """Two languages of 1,500 letters each beside English: all are told apart on held-out rows."""
    rng = random.Random(12)
    write = {"x": lambda: "".join(chr(0x4E00 + min(rng.randrange(1500), rng.randrange(1500))) for _ in range(80)), "y": lambda: "".join(chr(0x6000 + min(rng.randrange(1500), rng.randrange(1500))) for _ in range(80)), "en": lambda: " ".join(rng.choice(LANGS["en"].split()) for _ in range(20))}
    rows = [(i, write[lang](), lang) for i, lang in enumerate(rng.choices(list(write), k=400))]
    got = [r for r in language_id.identify(docs_of(rows)).collect() if r.held_out]
    right = [r.lang_pred == rows[r.doc_id][2] for r in got]
    assert len(got) > 50 and sum(right) >= 0.95 * len(got)


def test_the_sample_is_windows_of_rows(docs_of):
    docs = docs_of([(i, f"row{i} " + "word " * 5000, "en") for i in range(1, 40)] + [(90, "kurz", "de")])
    got = language_id.sample(docs, F.col("lang"), F.lit(True), sample_chars=1000, window_chars=100)
    assert len(got["en"]) == 1000 and got["de"] == "kurz"


def test_equal_languages_go_to_the_smaller_name():
    assert language_id.Parser({"b": "same text", "a": "same text"}).predict(["same text"])[0] == ["a"]


LANGS = {"en": "the of and to in that was with for this from house water", "fr": "le la de et les des une dans pour avec maison eau être", "de": "der die und das ist nicht mit von haus wasser über"}


def test_languages(docs_of):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(LANGS[lang].split()) for _ in range(rng.choice([5, 40, 700]))), lang) for i, lang in enumerate(rng.choices(list(LANGS), k=150))]
    rows += [(500, None, "en"), (501, "", "en"), (502, "12 ... 34", "fr"), (None, "the house and the water", "en"), (503, "das haus", None), (0, rows[0][1], rows[0][2])]
    got = language_id.identify(docs_of(rows, extra=["score", "held_out"]))
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"] and got.count() == len(rows)
    import zlib

    truth = {i: lang for i, _, lang in rows}
    for r in got.collect():
        assert 0 <= r.score <= 1
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
            assert r.lang_pred == ("und" if r.doc_id in (500, 501, 502) else truth[r.doc_id] or "de")


def test_languages_without_labels(docs_of):
    assert [r.lang_pred for r in language_id.identify(docs_of([(1, "abc", None)])).collect()] == ["und"]
    assert language_id.identify(docs_of([])).collect() == []


def test_toxicity(spark, docs_of):
    rng = random.Random(5)
    plain = [f"w{i}" for i in range(300)]

    def text(toxic, low):
        words = [rng.choice(plain) for _ in range(rng.randint(10, 200))]
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["moron", "scumbag", "loserish"]))
        return (" ### *** " if low else " ").join(words)

    cases = [(i, i % 5 == 0, i % 7 == 0) for i in range(600)]
    docs = docs_of([(i, text(t, low)) for i, t, low in cases] + [(900, None), (901, ""), (None, "moron scumbag loserish w1 w2 w3"), (902, "moron " * 2)], extra=["p_toxic", "quality"])
    labels = spark.createDataFrame([(i, int(not low), int(t)) for i, t, low in cases if i < 400] + [(None, 1, 1), (1, None, 1), (2, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    rows = toxicity.judge(docs, labels).collect()
    assert len(rows) == 604
    got = {r.doc_id: r for r in rows}
    assert not any(got[i].toxic for i, t, _ in cases if i >= 400 and not t)
    assert sum(got[i].toxic for i, t, _ in cases if i >= 400 and t) >= 34  # of 40
    assert sum((got[i].p_low_quality > 0.5) == low for i, _, low in cases if i >= 400) >= 185
    assert not got[900].toxic and not got[901].toxic and got[None].toxic
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and 900 in {r.doc_id for r in kept.collect()}


def test_toxicity_without_labels(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [tuple(r) for r in toxicity.judge(docs_of([(1, "a")]), labels).collect()] == [(1, 0.0, 0.0, False)]
    assert toxicity.judge(docs_of([]), labels).collect() == []


def test_chain_uses_earlier_categories():
    rng = np.random.default_rng(0)
    first = rng.random(400) < 0.5
    texts = [b"alpha beta " + (b"mark" if a else b"none") + b" w%d" % i for i, a in enumerate(first)]
    chain = toxicity.fit_chain(texts, np.column_stack([first, first]).astype(int), np.ones(400), ["a", "b"])
    assert len(chain.links[1].weights) == len(chain.links[1].features) + 2 and chain.links[1].weights[-2] > 0


def test_languages_of_many_letters_keep_them_all():
    """Four languages of 60 letters each and one of 900, no two with the same: more than a table has columns."""
    rng = random.Random(4)
    alphabets = {"a": (0x4E00, 60), "b": (0x5000, 60), "c": (0x5200, 60), "d": (0xAC00, 60), "e": (0x6000, 900)}
    write = lambda first, n, words: " ".join("".join(chr(first + min(rng.randrange(n), rng.randrange(n))) for _ in range(rng.randint(1, 5))) for _ in range(words))
    samples = {k: write(*v, 400) for k, v in alphabets.items()}
    texts = [write(*v, 30) for v in alphabets.values()] + [samples["e"][40:300] + " " + samples["b"][5:90], "\u4e00\u4e01 xyz " + samples["d"][:50]]
    parser = language_id.Parser(samples)
    assert parser.predict(texts)[0][:5] == list(alphabets)
    phrases, _ = parser.parse(texts)
    wide, _ = language_id.Parser(samples, max_symbols=5000).parse(texts)
    narrow, _ = language_id.Parser(samples, max_symbols=5).parse(texts)
    assert (phrases == wide).all() and (phrases == narrow).all()
    for i, t in enumerate(texts):
        for j, name in enumerate(parser.names):
            assert phrases[i, j] == plain_parse(language_id.squeeze(t), language_id.squeeze(samples[name]))
