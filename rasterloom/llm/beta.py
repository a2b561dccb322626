"""Quantiles of beta distributions as column expressions: nothing but built-in functions, evaluated in the JVM."""

from __future__ import annotations

from math import log, pi
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of the continued fraction; with the smaller parameter up to LARGE they are more than enough.
TERMS = 120
#: Beyond it in both parameters the Cornish-Fisher expansion is off by less than 1e-7.
LARGE = 2000
#: Steps of the search: Newton's, or halvings where that leaves the bracket.
STEPS = 24


def bind(value: Column, fn) -> Column:
    """fn(value), with value evaluated once however often fn uses it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def lgamma(x: Column) -> Column:
    """The logarithm of the gamma function for x > 0: Stirling's series, eight places up."""
    z = x + 8
    series = (z - 0.5) * F.log(z) - z + 0.5 * log(2 * pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    product = x
    for k in range(1, 8):
        product = product * (x + k)
    return series - F.log(product)


def fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, by Lentz's method; for x < (a + 1) / (a + b + 2)."""

    def step(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))

        def halves(e: Column) -> Column:
            d, c = 1 / (1 + e["even"] * s["d"]), 1 + e["even"] / s["c"]
            return bind(F.struct(d.alias("d"), c.alias("c"), e["odd"].alias("odd")), lambda h: bind(F.struct((1 / (1 + h["odd"] * h["d"])).alias("d"), (1 + h["odd"] / h["c"]).alias("c")), lambda n: F.struct(n["c"].alias("c"), n["d"].alias("d"), (s["h"] * h["d"] * h["c"] * n["d"] * n["c"]).alias("h"))))

        return bind(F.struct(even.alias("even"), odd.alias("odd")), halves)

    first = 1 / (1 - (a + b) * x / (a + 1))
    terms = F.transform(F.sequence(F.lit(1), F.lit(TERMS)), lambda m: m.cast("double"))
    return F.aggregate(terms, F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h")), step, lambda s: s["h"])


def cdf(a: Column, b: Column, x: Column, log_beta: Column) -> Column:
    """P(X <= x) of Beta(a, b); 0 < x < 1. log_beta: lgamma(a) + lgamma(b) - lgamma(a + b)."""
    front = F.exp(a * F.log(x) + b * F.log1p(-x) - log_beta)
    swap = x >= (a + 1) / (a + b + 2)
    turned = F.struct(F.when(swap, b).otherwise(a).alias("a"), F.when(swap, a).otherwise(b).alias("b"), F.when(swap, 1 - x).otherwise(x).alias("x"))
    part = bind(turned, lambda t: fraction(t["a"], t["b"], t["x"]) / t["a"]) * front
    return F.when(swap, 1 - part).otherwise(part)


def expansion(a: Column, b: Column, p: float) -> Column:
    """The quantile by the Cornish-Fisher expansion, for large a and b."""
    z, n = NormalDist().inv_cdf(p), a + b
    sd = F.sqrt(a * b / (n + 1)) / n
    skew = 2 * (b - a) * F.sqrt(n + 1) / ((n + 2) * F.sqrt(a * b))
    tails = 6 * ((a - b) * (a - b) * (n + 1) - a * b * (n + 2)) / (a * b * (n + 2) * (n + 3))
    return a / n + sd * (z + (z * z - 1) / 6 * skew + (z**3 - 3 * z) / 24 * tails - (2 * z**3 - 5 * z) / 36 * skew * skew)


def quantile(a: Column, b: Column, p: float) -> Column:
    """x with P(X <= x) = p of Beta(a, b), a and b > 0, to about 1e-7. Columns a and b should be plain ones: they are used often."""

    def search(q: Column) -> Column:
        def step(s: Column, _: Column) -> Column:
            x = s["x"]
            off = cdf(a, b, x, q["log_beta"]) - p

            def moved(f: Column) -> Column:
                low, high = F.when(f < 0, x).otherwise(s["low"]), F.when(f < 0, s["high"]).otherwise(x)
                newton = x - f / F.greatest(F.exp((a - 1) * F.log(x) + (b - 1) * F.log1p(-x) - q["log_beta"]), F.lit(1e-300))
                held = F.struct(low.alias("low"), high.alias("high"), newton.alias("newton"))
                # A root that is found stays: rounding may put it just outside the bracket.
                inside = lambda h: (h["newton"] > F.greatest(F.lit(0.0), h["low"] - 1e-12)) & (h["newton"] < F.least(F.lit(1.0), h["high"] + 1e-12))
                return bind(held, lambda h: F.struct(h["low"].alias("low"), h["high"].alias("high"), F.when(inside(h), h["newton"]).otherwise((h["low"] + h["high"]) / 2).alias("x")))

            return bind(off, moved)

        start = F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high"), F.least(F.greatest(a / (a + b), F.lit(1e-9)), F.lit(1 - 1e-9)).alias("x"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step, lambda s: s["x"])

    searched = bind(F.struct((lgamma(a) + lgamma(b) - lgamma(a + b)).alias("log_beta")), search)
    return F.when((a > LARGE) & (b > LARGE), expansion(a, b, p)).otherwise(searched)
