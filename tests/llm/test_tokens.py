"""Token counts under edits, packing and binary output against the tokenizers library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rasterloom.llm import binary_output, packing, token_counts
from rasterloom.llm.queries import QUERIES
from rasterloom.llm.tokens import pretokens, tokenizer_path

PIECES = ["a", "b", "'", "'s", "r", "e", " ", "  ", "\n", "\t", "1", "é", "中", "the ", "hello", ".", "\x85", "\x1c", " ", "ﬁ", "<|endoftext|>"]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokenizer_path())


def ids_of(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids


def scraps(rng, n, most=40):
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(most))) for _ in range(n)]


def test_ids_equal_the_tokenizer(plain):
    rng = random.Random(1)
    texts = [*scraps(rng, 1500), "x" * 5000, "y" * 1999 + " z", "", " " * 3000, "<|endoftext|>", "ab " * 2000]
    for text, got in zip(texts, pretokens(tokenizer_path()).encode(texts), strict=True):
        assert np.frombuffer(got, np.uint32).tolist() == ids_of(plain, text)


def test_counts_after_edits(plain):
    rng = random.Random(2)
    coder = pretokens(tokenizer_path())
    for text in [*scraps(rng, 250), "word " * 600, " " * 900, "".join(scraps(rng, 40)), "ab\n" * 400]:
        d, want = token_counts.Document(text, coder), text
        for new in [*scraps(rng, 5, 12), "", " " * 400]:
            n = len(want)
            start = rng.randint(0, n + 1)
            end = start + rng.choice([0, 1, 3, n])
            d.edit(start, end, new)
            want = want[:start] + new + want[end:]
            assert d.text == want and d.count() == len(ids_of(plain, want)) and d.tree.chars == len(want)
            assert [a.tolist() for a in d.leaves()] == [a.tolist() for a in token_counts.Document(want, coder).leaves()]


def test_an_edit_encodes_a_region_only():
    d = token_counts.Document("one two three four " * 2000, pretokens(tokenizer_path()))
    d.edit(20000, 20003, "changed")
    assert d.encoded < 12


def test_edit_table(spark, plain):
    rows = [
        (1, "hello world", [(0, 5, "bye"), (3, 3, " all")]),
        (2, None, [(0, 9, "new text")]),
        (3, "kept", None),
        (4, "cut", [(0, 100, None), None, (None, 1, "x")]),
        (None, "a b", [(-5, 1, "z")]),
        (1, "hello world", []),
        (5, "<|endoftext|> x", [(0, 1, "")]),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:int,end:int,text:string>>").withColumn("leaves", F.lit("extra"))
    after = ["bye all world", "new text", "kept", "", "z b", "hello world", "|endoftext|> x"]
    changes = dict(enumerate(r[2] for r in rows))
    trees = token_counts.build(df.coalesce(1)).collect()
    assert [(r.doc_id, r.n_tokens) for r in trees] == [(r[0], len(ids_of(plain, r[1]))) for r in rows]
    kept = spark.createDataFrame([(*r, changes[i]) for i, r in enumerate(trees)], token_counts.TREES + ", edits array<struct<start:int,end:int,text:string>>")
    got = [(r.doc_id, r.tokens_before, r.text, r.n_tokens) for r in token_counts.edit(kept.coalesce(1), F.col("edits")).collect()]
    assert got == [(r[0], len(ids_of(plain, r[1])), a, len(ids_of(plain, a))) for r, a in zip(rows, after, strict=True)]


def test_a_second_batch_starts_from_stored_trees(spark, docs_of, plain, tmp_path):
    """Each batch encodes the regions it touches, and what is stored equals a tree built anew."""
    rng = random.Random(9)
    texts = ["one two three four five " * 3000, "word\n" * 500, "", "x" * 70_000, " ".join(scraps(rng, 60))]
    trees = token_counts.build(docs_of(list(enumerate(texts)), extra=["leaves"]))
    half = (F.length("text") / 2).cast("int")
    batches = [F.array(F.struct(half.alias("start"), (half + 3).alias("end"), F.lit(put).alias("text"))) for put in (" first edit", "second\n\n", "")]
    for n, edits in enumerate(batches):
        trees.write.parquet(f"{tmp_path}/{n}")
        done = token_counts.edit(spark.read.parquet(f"{tmp_path}/{n}"), edits)
        for r in done.collect():
            before = texts[r.doc_id]
            k = len(before) // 2
            texts[r.doc_id] = before[:k] + (" first edit", "second\n\n", "")[n] + before[min(k + 3, len(before)) :]
            assert r.text == texts[r.doc_id] and r.tokens_before == len(ids_of(plain, before)) and r.n_tokens == len(ids_of(plain, r.text))
            assert r.n_encoded < 16
        trees = done.select("doc_id", "text", "leaves", "n_pretokens", "n_tokens")
    new = {r.doc_id: r for r in token_counts.build(docs_of(list(enumerate(texts)))).collect()}
    for r in trees.collect():
        assert [a.tolist() for a in token_counts.unpacked(r.leaves)] == [a.tolist() for a in token_counts.unpacked(new[r.doc_id].leaves)]


def test_count_all(docs_of, plain):
    docs = [(1, "some text here, and more of it"), (2, ""), (3, None), (4, "x")]
    for r in token_counts.count_all(docs_of(docs)).collect():
        text = dict(docs)[r.doc_id] or ""
        n, head = len(text), token_counts.HEADER
        new = head + text + token_counts.FOOTER
        for start, end, put in ((n // 2, min(n // 2 + 7, n), token_counts.MIDDLE), (n // 3, min(n // 3 + 12, n // 2), "")):
            end = max(start, end)
            new = new[: start + len(head)] + put + new[end + len(head) :]
        assert (r.tokens_before, r.tokens_after) == (len(ids_of(plain, text)), len(ids_of(plain, new)))
    assert token_counts.count_all(docs_of([])).collect() == []


def pack_rows(rng):
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "12", "é"]) for _ in range(rng.choice([0, 1, 3, 50, 400, 1100, 2500])))) for i in range(80)]
    return rows + [(500, None), (501, ""), (None, "x y"), (0, rows[0][1]), (0, rows[0][1]), (502, "<|endoftext|>"), *((600 + i, "same") for i in range(300))]


@pytest.mark.parametrize("spread", [0.25, 3])
def test_packing(docs_of, plain, spread):
    rows = pack_rows(random.Random(4))
    got = packing.pack(docs_of(rows, extra=["length", "salt", "rank"]), spread=spread).collect()
    want = defaultdict(int)
    for doc, text in rows:
        ids = [*ids_of(plain, text), 0]
        for s in range(0, len(ids), 1024):
            part = ids[s : s + 1024]
            want[doc, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)] += 1
    have = defaultdict(int)
    sequences = defaultdict(list)
    for r in got:
        have[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert have == want
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= -(-sum(n * k[2] for k, n in want.items()) // 1024) + 1


def test_pieces_of_one_id_are_spread(docs_of):
    """A third of all rows are of no doc_id and one length: their ranks come from many groups."""
    docs = docs_of([(None, None)] * 3000 + [(i, f"text {i}") for i in range(60)])
    got = packing.pack(docs).collect()
    assert len(got) == 3060 and len({(r.sequence_id, r.offset) for r in got}) == 3060
    numbered = packing.cut(docs, tokenizer_path()).select("number").distinct()
    assert numbered.count() == 3060


def test_closest_sum():
    rng = random.Random(5)
    for _ in range(200):
        counts = {rng.randint(1, 40): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
        room = rng.randint(0, 90)
        sums = {0}
        for length, n in counts.items():
            sums = {s + k * length for s in sums for k in range(n + 1)}
        used = packing.closest(counts, room)
        assert all(0 < n <= counts[k] for k, n in used.items())
        assert sum(k * n for k, n in used.items()) == max(s for s in sums if s <= room)


def test_packing_of_nothing(docs_of):
    assert packing.pack(docs_of([])).collect() == []
    assert binary_output.pack_matrix(docs_of([])).collect() == []


def test_rooms():
    rng = random.Random(6)
    rooms, held = binary_output.Rooms(100), []
    for i in range(2000):
        need = rng.randint(1, 100)
        if rng.random() < 0.5:
            rooms.add(need, i)
            held.append((need, i))
        else:
            found = rooms.take(need)
            fits = [r for r, _ in held if r >= need]
            assert (found is None) == (not fits)
            if found:
                assert found[1] == min(fits)
                held.remove((found[1], found[0]))


@pytest.mark.parametrize("chunk", [2_000_000, 3000])
def test_binary_output_is_lossless(docs_of, plain, chunk):
    rows = pack_rows(random.Random(7))
    got = binary_output.pack_matrix(docs_of(rows, extra=["row_id", "ids"]).repartition(2), chunk_tokens=chunk).collect()
    pieces = defaultdict(list)
    assert len({r.row_id for r in got}) == len(got)
    for r in got:
        ids, positions = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.positions, "<u4")
        assert len(ids) == len(positions) == 1024 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert not ids[r.n_tokens :].any() and not positions[r.n_tokens :].any()
        for a, b, doc, start in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.starts, strict=False):
            assert positions[a:b].tolist() == list(range(b - a))
            pieces[doc].append((start, ids[a:b].tolist()))
    want = defaultdict(list)
    for doc, text in rows:
        ids = [*ids_of(plain, text), 0]
        want[doc] += [(s, ids[s : s + 1024]) for s in range(0, len(ids), 1024)]
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}


def test_the_matrix_is_written_and_read_again(spark, docs_of, tmp_path):
    docs = docs_of(pack_rows(random.Random(8))).coalesce(1)
    packed = binary_output.pack_matrix(docs)
    want = sorted(map(tuple, packed.collect()))
    binary_output.write_matrix(packed, f"{tmp_path}/matrix")
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/matrix").collect())) == want
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op9_binary_output"](spark, str(tmp_path))
    assert got.schema == packed.schema and "/matrix-" in got.inputFiles()[0]
    assert len(got.collect()) == len(want)
