"""Quality rules, the conversation trie and whitening against plain Python, with odd inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.llm import conversation_trie, quality_rules, whitening

# quality rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count, covered = Counter(runs), set()
    for i, r in enumerate(runs):
        if count[r] > 1:
            covered.update(range(i, i + 8))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(covered)


def plain_kept(rows):
    """Verdicts of (lang, source, text) rows, quantiles from sorted buckets."""
    measures = [plain_measures(t) for _, _, t in rows]
    parts = [(1, 0), (2, 0), (4, 3), (5, 0)]
    groups = defaultdict(list)
    for (lang, source, _), m in zip(rows, measures, strict=True):
        if m[0]:
            for k, (a, b) in enumerate(parts):
                x = m[a] / m[b]
                bucket = math.ceil(math.log(x) / math.log(quality_rules.GAMMA)) if x else quality_rules.ZERO
                for key in ((0, lang, source, k), (1, lang, None, k), (2, None, None, k)):
                    groups[key].append(bucket)

    def quantile(key, p):
        b = sorted(groups[key])[math.ceil(len(groups[key]) * p) - 1]
        return 0.0 if b == quality_rules.ZERO else 2 * quality_rules.GAMMA**b / (quality_rules.GAMMA + 1)

    out = []
    for (lang, source, _), m in zip(rows, measures, strict=True):
        kept = failed = m[0] < 20 or 100 * m[5] > 30 * m[0]
        kept = not failed
        for k, (a, b) in enumerate(parts):
            key = next((g for g in ((0, lang, source, k), (1, lang, None, k), (2, None, None, k)) if len(groups[g]) >= quality_rules.LEAST), None)
            if m[0] and key:
                q1, q3 = quantile(key, 0.25), quantile(key, 0.75)
                reach = 3 * max(q3 - q1, quality_rules.METRICS[k].least_spread)
                kept &= m[a] / m[b] <= q3 + reach and (k > 0 or m[a] / m[b] >= q1 - reach)
        out.append((failed, kept))
    return out


def corpus():
    rng = np.random.default_rng(5)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "consectetur", "été", "naïve", "elit", "sed", "tempor", "𝛼𝛽"]
    rows = []
    for i in range(420):
        text = " ".join(rng.choice(words, rng.integers(1, 90)))
        if i % 9 == 0:
            text += "\n" + "\n".join(["same line again"] * (i % 5))
        if i % 17 == 0:
            text = " ".join(w + "###" for w in text.split())
        if i % 23 == 0:
            text = text.replace(" ", "\x0b\t\r ")
        if i % 29 == 0:
            text += " " + text
        if i % 31 == 0:
            text = "".join(text.split())
        rows.append((("en", "de", None)[i % 3 if i % 4 else 0], f"s{i % 7}" if i % 2 else "hot", text))
    return [*rows, ("en", "hot", None), ("en", None, ""), (None, None, " \n\t "), ("xx", "rare", "# " * 30), ("en", "hot", "word " * 60_000), ("en", "hot", rows[1][2]), ("en", "hot", rows[1][2])]


def test_quality_rules_equal_plain_python(spark, docs_of):
    rows = corpus()
    df = spark.createDataFrame([(i, t, lang, s, 0) for i, (lang, s, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in quality_rules.judge(df.repartition(5)).collect()}
    assert len(got) == len(rows)
    want = plain_kept(rows)
    for i, (_, _, text) in enumerate(rows):
        r, m = got[i], plain_measures(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (*m[:3], *m[4:]), text
        assert (r.base_failed, r.kept) == want[i], (i, text)
    assert {w for w in want} == {(True, False), (False, True), (False, False)}


def test_quality_rules_pass_rows_on(spark):
    df = spark.createDataFrame([(1, "one two " * 3 + " ".join(f"w{i}" for i in range(30)), "en", "s", 7, 8), (1, "x", "en", "s", 7, 8)], "doc_id long, text string, lang string, source string, n_words long, keep0 int")
    (left,) = quality_rules.drop_low_quality(df).collect()
    assert left.asDict() == df.first().asDict()
    assert quality_rules.judge(df.where("false")).count() == 0


def test_sketches_merge_to_the_whole(spark):
    """Sketches of parts, added up, are the sketch of all; its quantiles are within the accuracy."""
    rng = np.random.default_rng(2)
    words = (rng.pareto(1.5, 3000) * 40 + 20).astype(int)
    df = spark.createDataFrame([("en", f"s{i % 3}", int(w), int(w * rng.uniform(3, 9)), 0, 1, 0, 0) for i, w in enumerate(words)], "lang string, source string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long")
    whole = quality_rules.merged(quality_rules.sketches(df))
    halves = quality_rules.sketches(df.where("source = 's0'")).unionByName(quality_rules.sketches(df.where("source <> 's0'")))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, quality_rules.merged(halves).collect()))
    q = {r.metric: r for r in quality_rules.quartiles(whole).collect()}["word_length"]
    true = sorted(r.x for r in df.selectExpr("word_chars / n_words AS x").collect())
    for got, p in ((q.q1, 0.25), (q.q3, 0.75)):
        assert got == pytest.approx(true[math.ceil(3000 * p) - 1], rel=quality_rules.ACCURACY * 1.001)


def test_quality_rules_are_native(spark):
    from rasterloom.llm.queries import QUERIES

    df = QUERIES["op11_quality_rules"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for text in (df._jdf.queryExecution().toString(), quality_rules.measured(docs, F.col("doc_id"))._jdf.queryExecution().toString()):
        assert not any(word in text for word in ("Python", "Pandas", "Arrow"))


# conversation trie


def plain_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v, key=lambda x: x[:2])] for c, v in convs.items()}
    made = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        made[c] = tuple(own.get(base, [])[:h] + v[h:])
    members = defaultdict(list)
    for c, v in made.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if made[c] == p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


CONV = "conv_id long, turn long, role string, text string"


def random_conversations(seed, n=260):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(-7, n):
        if c % 13 == 5 or c == 100:
            continue
        for t in range(rng.integers(1, 9)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", "abcé𝛼"[: rng.integers(1, 6)] if c % 3 else "same"))
    return rows


@pytest.mark.parametrize(("seed", "turns"), [(1, 10), (2, 60), (3, 100_000)])
def test_trie_equals_plain_python(spark, seed, turns):
    """Also cut into many stretches, so that copies and long paths go over several."""
    rows = random_conversations(seed)
    rows += [(1000 + i, t, "user", "copy" * (t + 1)) for i in range(150) for t in range(8)]  # a group of copies
    rows += [(2001, t, "user", f"long {t}") for t in range(300)] + [(2002, t, "user", f"long {t}") for t in range(290)]
    rows += [(None, 1, "user", "lost"), (3000, None, None, None), (3000, None, None, None), (3000, 5, "a", ""), (3101, 1, "only", "one turn")]
    df = spark.createDataFrame(rows, CONV).repartition(5)
    assert sorted(map(tuple, conversation_trie.trie(df, turns).collect()), key=repr) == plain_trie(rows)


def test_trie_of_little(spark):
    assert conversation_trie.trie(spark.createDataFrame([], CONV)).count() == 0
    # crc32 of "3" leaves 4 modulo 6 and there is no conversation 0: no turn is left
    rows = [(3, 1, "user", "x")]
    df = spark.createDataFrame(rows, CONV).withColumn("key", F.lit("other")).withColumn("depth", F.lit(1))
    assert [tuple(r) for r in conversation_trie.trie(df).collect()] == plain_trie(rows)


def test_ends_stream_by_in_pieces(spark):
    """All conversations end at one node, whose ids come from many stretches."""
    rows = [(c, t, "user", "same") for c in range(0, 500) for t in range(6)]
    got = conversation_trie.trie(spark.createDataFrame(rows, CONV), 30)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_trie(rows)


# whitening


def plain_whitening(rows):
    """By length: (n, S, x of each row), and numpy's decomposition."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for size in {len(x) for _, x in kept} - {0}:
        fit = sorted({tuple(x) for _, x in kept if len(x) == size})
        n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
        a = np.array(fit, float) - np.array(sums) / n
        e, u = np.linalg.eigh(a.T @ a / n)
        e, u = e[::-1], u[:, ::-1]
        for i, x in ((i, x) for i, x in kept if len(x) == size):
            deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
            for k in range(min(4, size)):
                out.append((i, k + 1, n, deviation, (np.array(x) - np.array(sums) / n) @ u[:, k] / np.sqrt(e[k]) if e[k] > 1e-9 else None, e[k] / e.sum() if e.sum() > 0 and e[k] > 1e-9 else 0.0))
    return out


@pytest.mark.parametrize("at_once", [4096, 7])
def test_whitening_equals_numpy(spark, at_once):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 12)) * np.linspace(2, 0.1, 12) @ rng.normal(size=(12, 12))
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(400 + i, rows[0][1]) for i in range(200)] + [(5, rows[7][1]), (5, rows[7][1]), (None, rows[1][1])]
    rows += [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11), (904, [-0.0] * 12), (905, [])]
    rows += [(950 + i, [float(i), float(i * i % 7), 1.0]) for i in range(9)]  # of another length, one component without variance
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("x", F.lit(1)).withColumn("id", F.lit("a"))
    got = sorted(map(tuple, whitening.whiten(df, at_once=at_once).collect()), key=lambda r: (r[0] or -1, r[1], r[2], r[3]))
    want = sorted(plain_whitening(rows), key=lambda r: (r[0] or -1, r[1], r[2], r[3]))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for n in {r[2] for r in want}:
        for k in range(1, 5):
            mine, theirs = ([r for r in x if r[2] == n and r[1] == k] for x in (got, want))
            if theirs and theirs[0][4] is not None:
                a, b = np.array([r[4] for r in mine]), np.array([r[4] for r in theirs])
                assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
                assert mine[0][5] == pytest.approx(theirs[0][5], rel=1e-9) and mine[0][6] < 1e-9
            else:
                assert all(r[4] is None and r[5] == 0.0 for r in mine)


def test_whitening_of_little_and_of_much(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], schema)).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(one)] == [(v, k, 1, 0, None, 0.0, 0.0) for v in (1, 2) for k in (1, 2)]
    wide = whitening.whiten(spark.createDataFrame([(1, [1e13, 0.0]), (2, [0.0, 1.0]), (3, [2.0, 5.0])], schema)).collect()
    assert all(r.deviation is None for r in wide if r.vec_id == 1)
    exact = whitening.Model(3, [1, 2], 1 << 62, np.eye(2), np.ones(2), 2.0)  # beyond 64 bits in between, not in the result
    (r,) = spark.createDataFrame([([5, 6],)], "x array<long>").select(exact.deviation(F.col("x"))).collect()
    assert r[0] == (3 * 5 - 1) ** 2 + (3 * 6 - 2) ** 2
