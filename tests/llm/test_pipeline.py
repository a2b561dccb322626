"""The corpus pipeline, stage by stage and as a whole, over a corpus with planted cases."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from rasterloom.llm import near_dedup
from rasterloom.llm.tokens import tokenizer_path

RUDE = ["moron", "scumbag", "dimwit", "halfwit"]


def words(rng, n):
    return [rng.choice("bcdfgklmnprst") + rng.choice("aeiou") + rng.choice("bcdfgklmnprst") + rng.choice("aeiou") + rng.choice(["", "n", "r"]) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, spark):
    rng = random.Random(11)
    folder = tmp_path_factory.mktemp("corpus")
    base, passage, item = words(rng, 120), words(rng, 60), words(rng, 30)
    rows, kinds, labels = [], {}, []

    def add(kind, text, toxic=None):
        i = len(rows) * 2 + 10
        rows.append((i, text, "en", "s", len(text) if text is not None else None))
        kinds[i] = kind
        if toxic is not None:
            labels.append((i, 1, toxic))
        return i

    for i in range(300):
        add("clean", " ".join(words(rng, rng.randint(30, 150))), 0 if i < 200 else None)
        if i % 3 == 0:
            w = words(rng, rng.randint(30, 120))
            for r in rng.sample(RUDE, 3):
                w.insert(rng.randrange(len(w)), r)
            add("toxic", " ".join(w), 1 if i < 200 else None)
    for i in range(8):
        w = list(base)
        if i:
            w[i * 9] = "changed"
        add("near", " ".join(w))
    for _ in range(5):
        add("passage", " ".join(words(rng, 40) + passage + words(rng, 40)))
    for k in (0, 7, 15):
        add("leak", " ".join(words(rng, 30) + item[k : k + 14] + words(rng, 30)))
    add("null", None)
    add("empty", "")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item)), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), kinds, dict((r[0], r[1]) for r in rows), passage


def test_stages(spark, corpus):
    folder, kinds, texts, passage = corpus
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        kept.append({r.doc_id: r.text for r in docs.collect()})
    toxic, near, substring, leaks = kept
    count = lambda ids, kind: sum(kinds[i] == kind for i in ids)
    assert count(toxic, "toxic") <= 5 and count(toxic, "clean") == 300
    assert set(toxic) - set(near) == set(sorted(i for i in toxic if kinds[i] == "near")[1:])
    assert set(substring) == set(near)
    with_passage = sorted(i for i in near if kinds[i] == "passage")
    first = with_passage[0]
    for i in with_passage:
        assert (" ".join(passage) in substring[i]) == (i == first)
    assert all(substring[i] == texts[i] for i in near if kinds[i] in ("clean", "leak", "null", "empty"))
    assert set(substring) - set(leaks) == {i for i in near if kinds[i] == "leak"}


def test_run_packs_what_is_left(spark, corpus):
    folder = corpus[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    plain = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in docs.collect():
        ids = [*plain.encode(r.text or "", add_special_tokens=False).ids, 0]
        for s in range(0, len(ids), 1024):
            want[r.doc_id, s, zlib.crc32(np.array(ids[s : s + 1024], "<u4").tobytes())] += 1
    got = corpus_pipeline.run(spark, folder)
    assert Counter((r.doc_id, r.start, r.ids_crc32) for r in got.collect()) == want
    assert entry.queries()["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None


def test_empty_corpus(spark, tmp_path):
    schema = {"documents": "doc_id long, text string, lang string, source string, n_chars long", "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}
    for name, columns in schema.items():
        spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_odd_rows_and_columns(spark, corpus):
    folder = corpus[0]
    rows = [(None, None, None), (None, "some words here", 1), (5, "some words here", 1), (5, "some words here", 1), (6, "x" * 4000, 2), (7, "la " * 30000, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumns({c: F.lit(1) for c in ("row", "out", "payload", "id", "tag", "spans", "node")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        assert {r.doc_id for r in out.collect()} == {None, 5, 6, 7}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() >= 6


def test_near_duplicates_from_eighty_percent(spark, docs_of):
    """Of 96 shingles a changed word takes 5: two changes leave 86 of 106 (81 %), three leave 81 of 111 (73 %)."""
    base = words(random.Random(3), 100)
    two, three = list(base), list(base)
    two[20] = two[60] = "changed"
    three[10] = three[40] = three[80] = "other"
    docs = docs_of([(1, " ".join(base)), (2, " ".join(two)), (3, " ".join(three))])
    assert sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, "").collect()) == [1, 3]
    assert near_dedup.drop_near_duplicates(docs).count() == 3
    assert near_dedup.bands_for(85) == 32 and near_dedup.bands_for(80) == 53


def test_whole_texts_are_packed(spark, corpus):
    assert not re.search(r"\.limit\(|\.sample\(", open(corpus_pipeline.__file__).read())
