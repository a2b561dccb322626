"""One row that is there a thousand times: the result is that of brute force, and nothing meets n times n. Also very long texts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rasterloom.llm import common, decontaminate, exact_topk, language_id, near_dedup, substring_dedup, token_counts
from tests.llm.test_text_dedup import brute_components, prose


def windows_of(text):
    w = text.split()
    return {tuple(w[k : k + 13]) for k in range(len(w) - 12)}


def test_a_repeated_document_does_not_fill_the_sample(docs_of):
    rng = random.Random(4)
    rows = [(i, prose(rng, 500) + f" own{i}", "en") for i in range(399)]
    (least,) = docs_of(rows).orderBy(F.xxhash64("doc_id")).limit(1).select("doc_id").first()
    once = language_id.sample(docs_of(rows), F.col("lang"), F.lit(True))
    again = language_id.sample(docs_of(rows + [rows[least]] * 50), F.col("lang"), F.lit(True))
    assert once == again and len(again["en"]) == language_id.SAMPLE_CHARS


def test_repeated_rows_are_confirmed_once(docs_of, monkeypatch):
    rng = random.Random(5)
    text = prose(rng, 200)
    near = text.replace(text.split()[100], "other", 1)
    rows = [(1, text)] * 1000 + [(2, near)] * 1000 + [(3, prose(rng, 100)), (4, text + " more"), (4, text + " more"), (4, "quite another text on this id " * 2), (None, text)]
    met, real = [], near_dedup.confirm
    monkeypatch.setattr(near_dedup, "confirm", lambda pairs, sets, percent=85: met.append((sets.count(), sets.dropDuplicates().count())) or real(pairs, sets, percent))
    got = near_dedup.near_duplicates(docs_of(rows).repartition(4)).collect()
    assert met and all(n == distinct <= 4 for n, distinct in met)
    want = {r[0]: r for r in brute_components([(1, text), (2, near), *rows[2000:]]) if r[0] != 4}
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert all(tuple(r) == want[r.doc_id] for r in got if r.doc_id != 4) and {r.component_id for r in got if r.doc_id == 4} == {1}


def test_repeated_rows_start_windows_once(docs_of, monkeypatch):
    rng = random.Random(6)
    text, earlier = prose(rng, 42), prose(rng, 20)
    late = f"{text} {earlier}"
    rows = [(1, earlier + " " + text)] + [(7, late)] * 1000 + [(8, earlier)]
    most, real = len(windows_of(late)), substring_dedup.words_of_windows

    def counted(batches):
        for batch in batches:
            if any(len(s) + sum(len(p) // 4 for p in packed) > most for s, packed in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                raise AssertionError("a window starts more than once")
            yield from real(iter([batch]))

    monkeypatch.setattr(substring_dedup, "words_of_windows", counted)
    got = substring_dedup.digest(docs_of(rows).repartition(4)).collect()
    removed = {r.doc_id: r.n_removed for r in got}
    assert len(got) == len(rows) and removed == {1: 0, 7: 62, 8: 20}


def test_counts_of_odd_rows(docs_of):
    """Repeated rows, a null id, a text of half a million characters, and columns whose names clash."""
    rows = [(1, "one two"), (1, "one two"), (None, "one two"), (2, "word " * 100_000), (3, None)]
    got = token_counts.count_all(docs_of(rows, extra=["tree", "row", "out", "tokens"])).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    plain = token_counts.count_all(docs_of(rows)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, plain))


def test_one_very_long_text(spark, docs_of):
    rng = random.Random(7)
    passage = prose(rng, 40)
    long = prose(rng, 150_000) + " " + passage
    rows = [(1, passage), (2, long), (3, long + " end")]
    cut = {r.doc_id: r for r in substring_dedup.digest(docs_of(rows)).collect()}
    assert cut[2].n_removed == 40 and cut[3].n_words - cut[3].n_removed <= 13
    items = spark.createDataFrame([(5, passage)], "item_id long, text string")
    hit = {r.doc_id: r for r in decontaminate.digest(docs_of(rows), items).collect()}
    assert {i: r.n_hit for i, r in hit.items()} == {1: 40, 2: 40, 3: 40} and hit[2].n_words == 150_040
    same = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs_of(rows)).collect()}
    assert same == {1: 1, 2: 2, 3: 2}


def test_vectors_of_many_dimensions(spark):
    rng = random.Random(8)
    rows = [(i, [rng.randint(-50, 50) / 64 for _ in range(3000)]) for i in range(45)]
    got = exact_topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = {i: [round(64 * c) for c in v] for i, v in rows}
    for q in (0, 20, 40):
        want = sorted(((-sum(a * b for a, b in zip(x[q], x[c], strict=True)), c) for c in x if c != q))[:20]
        assert [(-r.score, r.vec_id) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == want


def test_tiles_grow_with_the_table(spark, monkeypatch):
    assert exact_topk.tile_sizes(0, 0, 0) == exact_topk.tile_sizes(256_410, 12_820, 64) == (4096, 8192)
    block, shard = exact_topk.tile_sizes(10**9, 5 * 10**7, 64)
    assert block == shard == 65_536 and exact_topk.tile_sizes(10**9, 5 * 10**7, 1024) == (4096, 8192)
    vectors = exact_topk.quantised(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"))
    found = lambda: sorted(map(tuple, exact_topk.search(vectors, F.col("id") % 20 == 0).collect()))
    want = found()
    monkeypatch.setattr(exact_topk, "BLOCK", 1)
    monkeypatch.setattr(exact_topk, "SHARD", 2)
    monkeypatch.setattr(exact_topk, "TILES", 30)
    monkeypatch.setattr(exact_topk, "SCORES", 3)
    assert found() == want


@pytest.mark.parametrize("rows", [[], [(1, "a b")]])
def test_tables_of_the_matrix_go(spark, docs_of, rows):
    from rasterloom.llm import binary_output

    mark = common.tables_made()
    assert binary_output.written_matrix(binary_output.pack_matrix(docs_of(rows))).count() >= 0 and common.tables_made() > mark
    common.remove_tables(mark)
