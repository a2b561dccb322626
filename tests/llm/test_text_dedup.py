"""Decontamination, substring dedup and near-duplicates against brute force, with nulls, short and long texts, ties and repeats."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.llm import components, decontaminate, near_dedup, substring_dedup

VOCAB = [f"{a}{b}" for a in "abcdefghij" for b in ("an", "er", "ić", "o1", "Us")]


def prose(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def corpus(seed, n=120):
    """Documents with copies, near copies, shared passages, hot windows and awkward texts."""
    rng = random.Random(seed)
    passage, base = prose(rng, 30), prose(rng, 80).split()
    rows = []
    for i in range(n):
        kind = i % 6
        if kind == 0:
            text = prose(rng, rng.choice([1, 4, 5, 12, 13, 14, 60, 200]))
        elif kind == 1:
            text = prose(rng, 20) + "\n" + passage + "\t" + prose(rng, 9)
        elif kind == 2:
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                words[rng.randrange(len(words))] = rng.choice(VOCAB)
            text = " ".join(words)
        elif kind == 3:
            text = rows[rng.randrange(len(rows))][1] if rng.random() < 0.5 else "la " * rng.choice([3, 13, 40])
        else:
            text = prose(rng, 50)
        rows.append((i * 3 % n + 1000 * (i % 2), text))
    rows += [(5001, None), (5002, ""), (5003, " \n\t "), (None, passage), (None, None), rows[1], rows[1], (rows[2][0], rows[2][1] + " again"), (5004, passage.upper()), (5005, "\x1c\x85 　" + passage)]
    return rows


def split(text):
    return [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]


def az(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


@pytest.mark.parametrize("seed,options,cells", [(1, {}, None), (2, {"chunk_words": 100}, None), (3, {"chunk_words": 400}, (64, 256)), (4, {"chunk_words": 30}, (1 << 12, 1 << 13))])
def test_substring_dedup(docs_of, monkeypatch, seed, options, cells):
    """cells: small ranges, so that there are many of them, and more windows than cells in some."""
    if cells:
        monkeypatch.setattr(substring_dedup, "RANGE_CELLS", cells)
        monkeypatch.setattr(substring_dedup, "RANGES", 4)
    rows = corpus(seed)
    least = {}
    for i, t in rows:
        w = split(t)
        for k in range(len(w) - 12):
            if i is not None:
                s = tuple(w[k : k + 13])
                least[s] = min(i, least.get(s, i))
    want = []
    for i, t in rows:
        w = split(t)
        keep = [True] * len(w)
        for k in range(len(w) - 12):
            if i is not None and least[tuple(w[k : k + 13])] < i:
                keep[k : k + 13] = [False] * 13
        want.append((i, len(w), keep.count(False), hashlib.sha256(" ".join(x for x, k in zip(w, keep, strict=True) if k).encode()).hexdigest()))
    got = substring_dedup.dedup(docs_of(rows, extra=["tag", "hits", "row", "out", "spans"]).repartition(3), F.struct("doc_id"), **options).select("row.doc_id", "out.n_words", "out.n_removed", "out.kept_sha256")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_the_sketch_grows_with_the_corpus(docs_of):
    """Few windows pass that aren't repeated, at one width per window; a chunk without an answer passes whole."""
    rng = np.random.default_rng(1)
    for n in (1000, 20_000):
        h = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        cells, width = 6 * n // 64 * 64, 32
        own, counts = np.unique(substring_dedup.cells_of(h, cells), return_counts=True)
        cuts = substring_dedup.by_range(own, cells, width)
        parts = [(r, b"k", substring_dedup.pack_cells((own[a:b] - np.uint64(r * width))[counts[a:b] == 1])) for r, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]
        told = [{"range": r, "bits": np.packbits(np.zeros(len(substring_dedup.unpack_cells(once)), bool)).tobytes()} for r, _, once in parts]
        assert substring_dedup.repeated_in(h, told, cells, width).mean() < 0.12
        assert substring_dedup.repeated_in(h, None, cells, width).all()
        assert substring_dedup.repeated_in(np.r_[h, h], told, cells, width).all()


def test_repeats_are_cut_from_texts(docs_of):
    rng = random.Random(9)
    passage = prose(rng, 20)
    rows = [(1, f"first  one\n{passage}\nend"), (2, f"second\n\nline {passage} tail  of it"), (3, None), (4, "short")]
    df = docs_of(rows, extra=["id"])
    out = substring_dedup.remove_repeats(df)
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text == rows[0][1] and got[2].text == "second\n\nline tail  of it" and got[2].n_chars == len(got[2].text)
    assert got[3].text is None and got[3].n_chars is None and got[4].text == "short"


def test_substring_dedup_of_nothing(docs_of):
    assert substring_dedup.digest(docs_of([])).collect() == []


@pytest.mark.parametrize("seed,block", [(1, 200_000), (2, 7)])
def test_decontamination(spark, docs_of, seed, block):
    rng = random.Random(seed)
    items = [(1, prose(rng, 25)), (2, prose(rng, 3)), (10, prose(rng, 10)), (3, None), (4, "!?"), (None, prose(rng, 12)), (1, prose(rng, 11)), (5, "la la la la la la la la la la la"), (6, "x"), (7, prose(rng, 25))]
    rows = corpus(seed, 60)
    rows += [(6000 + n, prose(rng, 5) + " " + az(t).upper()[: rng.choice([80, 200])] + " " + prose(rng, 3)) for n, (_, t) in enumerate(items) if t]
    words = lambda t: __import__("re").findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", az(t))
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        k = min(10, len(w))
        if i is not None and k:
            for s in range(len(w) - k + 1):
                windows[tuple(w[s : s + k])].add(str(i))
    want = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for win, ids in windows.items():
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s : s + len(win)]) == win:
                    hit.update(range(s, s + len(win)))
                    found |= ids
        want.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    docs = docs_of(rows, extra=["spans", "items", "row", "key", "hits", "_id"])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_contamination(docs, benchmark, F.struct("doc_id"), block_windows=block)
    got = found.select("row.doc_id", "out.n_words", "out.n_hit", F.size("out.items").cast("long"), F.sha2(F.concat_ws(",", "out.items"), 256), F.col("out.n_hit") > 0)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert found._jdf.queryExecution().toString().count("MapInArrow [") <= 4  # one pass, in each of the four plans that are shown
    assert decontaminate.digest(docs, benchmark).columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == sum(not w[-1] for w in want)


def test_decontamination_without_items(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in decontaminate.digest(docs_of([(1, "a b")]), none).collect()] == [(1, 2, 0, 0)]
    assert decontaminate.digest(docs_of([]), spark.createDataFrame([(1, "a")], "item_id long, text string")).collect() == []


def test_decontamination_by_joins_equals_the_broadcast_one(spark, monkeypatch):
    """The given tables: a benchmark that is too large for one block gives the same rows, also where every bit of the bitmap is set."""
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    spans = lambda block: sorted(map(repr, decontaminate.find_contamination(docs, items, F.struct("doc_id"), block_windows=block).select("row.doc_id", "out.*").collect()))
    want = spans(1_000_000)
    assert sum("spans=bytearray(b'')" not in r for r in want) > 0
    assert spans(20) == want
    monkeypatch.setattr(decontaminate, "marks_of", lambda hashes: np.full(64, 255, np.uint8))
    assert spans(20) == want


def brute_components(rows):
    sets = []
    for i, t in rows:
        w = split(az(t))
        sets.append((i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    up = {i: i for i, _ in sets if i is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return [(i, len(s), None if i is None else top(i), i is None or top(i) == i) for i, s in sets]


@pytest.mark.parametrize("seed,block", [(1, 8192), (2, 3), (4, 8192)])
def test_near_duplicates(docs_of, seed, block):
    rows = corpus(seed)
    documents, labels = near_dedup.link(docs_of(rows, extra=["node", "h1", "key"]), block=block)
    labels = {r.node: r.component for r in labels.collect()}
    got = near_dedup.near_duplicates(docs_of(rows, extra=["node", "h1", "key"])).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_components(rows)))
    for r in documents.collect():
        if r.doc_id is not None and r.node is not None:
            assert labels.get(r.node, r.node) <= r.doc_id


def test_near_duplicates_that_leave(docs_of):
    rows = [(7, "a b c d e f"), (3, "A b c d e f"), (9, None), (8, "z"), (None, "a b c d e f"), (7, "a b c d e f")]
    df = docs_of(rows, extra=["node"])
    out = near_dedup.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted(map(repr, (r.doc_id for r in out.collect()))) == sorted(map(repr, [3, 9, 8, None]))
    assert near_dedup.near_duplicates(docs_of([])).collect() == []


def test_a_chain_is_one_component(docs_of):
    """Each document is close to the next only; the ends are far apart."""
    rng = random.Random(2)
    words, rows = prose(rng, 200).split(), []
    for i in range(30):
        rows.append((i, " ".join(words)))
        for k in range(2):
            words[(i * 2 + k) * 3 % 200] = f"new{i}{k}"
    got = near_dedup.near_duplicates(docs_of(rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows))


def test_sequential_comparison_keeps_what_is_similar():
    least = near_dedup.least_equal(near_dedup.VALUES)
    assert list(least) == sorted(least)
    rng = np.random.default_rng(1)
    a = rng.integers(0, 256, (2000, near_dedup.VALUES), dtype=np.uint8)
    b = np.where(rng.random(a.shape) < 0.87, a, rng.integers(0, 256, a.shape, dtype=np.uint8))
    far = np.where(rng.random(a.shape) < 0.6, a, rng.integers(0, 256, a.shape, dtype=np.uint8))
    assert len(near_dedup.survivors(a, b.astype(np.uint8))[0]) == 2000
    assert len(near_dedup.survivors(a, far.astype(np.uint8))[0]) == 0


@pytest.mark.parametrize("block", [8192, 1])
def test_a_band_that_only_looks_shared_takes_no_pair(spark, block):
    """Six of seven values of bands 0 to 4 are equal and the seventh has the same byte by chance; band 5 is the first shared one."""
    rng = np.random.default_rng(5)
    signs = np.tile(rng.integers(0, 1 << 63, near_dedup.VALUES, dtype=np.uint64), (2, 1))
    for band in range(5):
        at = band * near_dedup.ROWS
        others = rng.integers(0, 1 << 63, 10_000, dtype=np.uint64)
        signs[1, at] = others[near_dedup.mixed(others, 7).astype(np.uint8) == near_dedup.mixed(signs[0, at : at + 1], 7).astype(np.uint8)][0]
    small = near_dedup.mixed(signs, 7).astype(np.uint8)
    assert (small[0] == small[1]).all() and (signs[0] != signs[1]).sum() == 5
    bands = [near_dedup.mixed(near_dedup.run_hashes_of_rows(signs[:, b * near_dedup.ROWS : (b + 1) * near_dedup.ROWS]), seed).view(np.int64).tolist() for b, seed in enumerate(near_dedup.BAND_SEEDS)]
    nodes = spark.createDataFrame([(n + 1, 100, small[n].tobytes(), [b[n] for b in bands]) for n in range(2)], "node long, size long, sketch binary, bands array<long>")
    members = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    labels = spark.createDataFrame([], "node long, component long")
    for partners in near_dedup.PARTNERS:
        got = near_dedup.cross_pairs(members, nodes, labels, partners, block).collect()
        assert [tuple(r)[:3] for r in got] == [(1, 2, near_dedup.VALUES)]


@pytest.mark.parametrize("partners,block", [((1, 2, None), 8192), ((1, None), 3), ((1,), 8192)])
def test_partners_that_were_kept_back(docs_of, monkeypatch, partners, block):
    """The leader of every bucket is an outlier, and the others' best partners in a component aren't similar enough: only blocks that kept
    partners back are compared again, and no link is lost. With one round only, some are."""
    rng = random.Random(6)
    base = prose(rng, 120).split()
    rows = []
    for i in range(40):
        words = list(base)
        for k in rng.sample(range(120), rng.choice([1, 2, 3, 4])):
            words[k] = f"w{i}x{k}"
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(near_dedup, "PARTNERS", partners)
    documents, labels = near_dedup.link(docs_of(rows), block=block)
    found = {r.node: r.component for r in labels.collect()}
    want = {i: c for i, _, c, _ in brute_components(rows)}
    got = {r.doc_id: found.get(r.node, r.node) for r in documents.collect()}
    assert got == want if partners[-1] is None else all(want[i] <= c for i, c in got.items())


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(200, x) for x in range(201, 230)]
    up = list(range(300))
    for a, b in edges:
        x, y = up[a], up[b]
        up = [min(x, y) if u in (x, y) else u for u in up]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: up[n] for e in edges if e[0] != e[1] for n in e}
