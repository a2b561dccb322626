"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a sample of labelled text. A document is cross-parsed against every
automaton: from where the last phrase ended, the next phrase is the longest match with the sample. A symbol that the sample lacks
counts as two phrases, an escape and itself. A language whose sample
resembles the document needs few, long phrases. Phrases are normalised to bits per symbol, phrases * log2(sample size) /
symbols; the fewest win, ties go to the smaller language name. The score is 2**-bits of the winner over the sum for all.

Texts are lower-cased, every run of non-letters is one blank, letters outside a language's sample match nothing in it. Whole
texts are parsed. Each batch is parsed in lockstep: texts are cut into lanes of `lane` symbols, and all lanes take a step at a time
through a dense transition table, so the work is numpy gathers. A lane at first starts a phrase of its own; then the lanes whose
predecessor ended inside a phrase go on from there until they are in the state that they were in before, which mostly takes a
phrase or two. The phrases are thus those of the whole text, whatever the lanes. The table has a
column for each of a language's commonest letters, up to `max_symbols` columns; its other letters, as of Chinese, are looked up in
a sorted list of transitions, with the same result.

What is fitted: windows of at most `window_chars` characters, at a place that a hash chooses, of labelled rows chosen by a hash of
the id, until there are `sample_chars` characters a language (bounds are parameters). Only text and the label are used for fitting,
only text for predicting.

Cases: a null text or one without a letter gives `und` with score 0, as does any text if nothing is labelled. Rows with a
null id or label are never fitted, and an id on several rows gives its label one window. Repeated rows get a row each.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import as_table, bounded_batches, cache, enter, join_counted

SAMPLE_CHARS = 40_000
SAMPLE_ROWS = 400
WINDOW_CHARS = 4_000
MAX_SYMBOLS = 96
LANE = 512
#: So many times lanes are gone over again together, unless so few are left.
ROUNDS, FEW = 6, 12
SLICE_CHARS = 2_000_000
BLANK, OTHER, FIRST = 0, 1, 2
UNKNOWN = "und"

_parsers: dict[str, Parser] = {}
cache("parsers", _parsers.clear)


def sample(docs: DataFrame, label: Column, usable: Column, *, id_col: str = "doc_id", text_col: str = "text", sample_chars: int = SAMPLE_CHARS, sample_rows: int = SAMPLE_ROWS, window_chars: int = WINDOW_CHARS) -> dict[str, str]:
    """A bounded text for each label. Rows are thinned by a hash of their id before any are gathered by label."""
    rows = docs.select(label.cast("string").alias("label"), F.col(id_col).alias("id")).where(usable & label.isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    share = rows.groupBy("label").agg((F.lit(4.0) * sample_rows / F.approx_count_distinct("id")).alias("share"))
    unit = F.shiftrightunsigned(F.xxhash64("id"), 11) / F.lit(float(1 << 53))
    # Only ids and labels are gathered before the sample is drawn; about 4 * sample_rows ids a label are left.
    thin = as_table(rows.join(share, "label").where(unit < F.col("share")).select("id").distinct(), "sample")
    begin = F.pmod(F.xxhash64(id_col, F.lit("window")), F.greatest(F.lit(1), F.length(text_col) - window_chars + 1)) + 1
    window = F.substring(text_col, begin.cast("int"), F.lit(window_chars))
    texts = docs.where(usable & label.isNotNull()).select(label.cast("string").alias("label"), F.col(id_col).alias("id"), window.alias("text"))
    # One window an id, before any row leaves its task: an id may be on any number of rows.
    drawn = join_counted(texts, thin, ["id"], "left_semi").where("text is not null").groupBy("label", "id").agg(F.min("text").alias("text")).withColumn("h", F.xxhash64("id"))
    first = Window.partitionBy("label").orderBy("h")
    chosen = drawn.withColumn("before", F.sum(F.length("text")).over(first.rowsBetween(Window.unboundedPreceding, -1)))
    out: dict[str, list[str]] = {}
    for r in chosen.where(F.coalesce("before", F.lit(0)) < sample_chars).orderBy("label", "h").toLocalIterator():
        out.setdefault(r.label, []).append(r.text)
    return {k: " ".join(v)[:sample_chars] for k, v in out.items()}


def squeeze(text: str) -> str:
    """Lower case, runs of non-letters as one blank."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton (the directed acyclic word graph of Blumer et al.), state 0 first."""
    edges: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(edges)
        edges.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = new
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                split = len(edges)
                edges.append(dict(edges[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = split
                    p = link[p]
                link[q] = link[new] = split
        last = new
    return edges


class Parser:
    """Dense tables over the automata: table[state * width + symbol] = next state * width * 4 + phrases that end here. Each language has
    symbols of its own, which `local` gives for the common ones; those from width on are in its sparse transitions."""

    def __init__(self, samples: dict[str, str], max_symbols: int = MAX_SYMBOLS, lane: int = LANE) -> None:
        texts = {k: s for k in sorted(samples) if (s := squeeze(samples[k])).strip()}
        self.names, self.lane = list(texts), lane
        letters = sorted(set("".join(texts.values())) - {" "})
        # The class of every code point, by str.isalpha; surrogates don't occur in UTF-8 text.
        self.symbol = np.fromiter((OTHER if chr(c).isalpha() else BLANK for c in range(0x110000)), np.min_scalar_type(FIRST + len(letters)), 0x110000)
        for i, c in enumerate(letters):
            self.symbol[ord(c)] = FIRST + i
        self.local, self.widths, self.tables, self.sparse = [], [], [], []
        for t in texts.values():
            own = [self.symbol[ord(c)] for c, _ in sorted(Counter(t).items(), key=lambda x: (-x[1], x[0])) if c != " "]
            local = np.full(FIRST + len(letters), OTHER, np.int32)
            local[BLANK] = BLANK
            local[own] = np.arange(FIRST, FIRST + len(own))
            width = min(FIRST + len(own), max_symbols)
            edges = automaton(local[self.encode(t)].tolist())
            self.local.append(local)
            self.widths.append(width)
            self.tables.append(self.table(edges, width))
            self.sparse.append(self.transitions(edges, width, FIRST + len(own) - width))
        self.bits = np.log2([max(2, len(t)) for t in texts.values()])

    def encode(self, text: str) -> np.ndarray:
        return self.symbol[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    @staticmethod
    def table(edges: list[dict[int, int]], width: int) -> np.ndarray:
        root = np.full(width, -1, np.int64)
        for c, q in edges[0].items():
            if c < width:
                root[c] = q
        # After a failed step the symbol starts a phrase, or is an escape and a phrase of its own if the sample lacks it.
        restart = np.where(root >= 0, root * width * 4 + 1, 3)
        out = np.tile(restart, (len(edges), 1))
        out[0] = np.where(root >= 0, root * width * 4, 2)
        for state, e in enumerate(edges):
            for c, q in e.items():
                if c < width:
                    out[state, c] = q * width * 4
        # By states, not by entries: a target may be reached by a sparse transition only.
        return out.astype(np.int32 if len(edges) * width * 4 < 2**31 else np.int64).ravel()

    @staticmethod
    def transitions(edges: list[dict[int, int]], width: int, rare: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Of the symbols from width on: sorted keys state * width * rare + symbol - width, their entries, and the entries after a
        failed step by symbol (all are in the sample, so each starts a phrase). None if there are no such symbols."""
        if not rare:
            return None
        found = sorted((state * width * rare + c - width, q * width * 4) for state, e in enumerate(edges) for c, q in e.items() if c >= width)
        keys, entries = np.array(found, np.int64).T
        return keys, entries, np.array([edges[0][width + c] * width * 4 + 1 for c in range(rare)], np.int64)

    def parse(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases by text and language; symbols by text (0 if it has no letter)."""
        lowered = [t.lower() for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
        symbols = self.encode("".join(lowered))
        first = np.ones(len(symbols), bool)
        first[1:] = owner[1:] != owner[:-1]
        keep = symbols != BLANK
        keep[1:] |= (symbols[:-1] != BLANK) & ~first[1:]
        lettered = np.bincount(owner[symbols != BLANK], minlength=len(texts))
        symbols, owner = symbols[keep], owner[keep]
        lengths = np.bincount(owner, minlength=len(texts))
        begins = np.cumsum(lengths) - lengths
        lanes = -(-lengths // self.lane)
        of = np.repeat(np.arange(len(texts)), lanes)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start, size = begins[of] + nth * self.lane, np.minimum(self.lane, lengths[of] - nth * self.lane)
        order = np.argsort(-size, kind="stable")
        phrases = np.zeros((len(texts), len(self.names)), np.int64)
        for lang in range(len(self.names)):
            entries = np.empty(len(symbols), self.tables[lang].dtype)
            local = self.local[lang].take(symbols)
            for i in range(0, len(order), 8192):
                self.step(lang, local, entries, start[order[i : i + 8192]], size[order[i : i + 8192]])
            self.stitch(lang, local, entries, start, size, nth > 0)
            ends = (begins + lengths - 1)[lengths > 0]
            phrases[:, lang] = np.bincount(owner, entries & 3, len(texts))
            phrases[lengths > 0, lang] += entries[ends] >> 2 != 0  # the last phrase has no symbol after it
        return phrases, np.where(lettered > 0, lengths, 0)

    def entry_after(self, lang: int, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The table's entries for states and symbols of a language, dense or sparse."""
        table, width, sparse = self.tables[lang], self.widths[lang], self.sparse[lang]
        if sparse is None:
            return table.take(state + symbol)
        entry = table.take(state + np.where(symbol < width, symbol, OTHER))
        at = np.flatnonzero(symbol >= width)
        if len(at):
            keys, entries, restart = sparse
            rare = symbol[at] - width
            key = state[at].astype(np.int64) * len(restart) + rare
            nearest = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            entry[at] = np.where(keys[nearest] == key, entries[nearest], restart[rare])
        return entry

    def step(self, lang: int, local: np.ndarray, entries: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Fills in the entries of lanes, longest lane first, each from the start of a phrase."""
        steps = int(size[0]) if len(size) else 0
        state = np.zeros(len(size), entries.dtype)
        for t, a in enumerate(np.searchsorted(-size, -np.arange(steps), side="left")):
            at = start[:a] + t
            entry = self.entry_after(lang, state[:a], local[at])
            entries[at] = entry
            state[:a] = entry >> 2

    def stitch(self, lang: int, local: np.ndarray, entries: np.ndarray, start: np.ndarray, size: np.ndarray, inner: np.ndarray) -> None:
        """Goes over the lanes again that should have begun inside a phrase, until each begins where the one before it ends.

        inner: whether the lane before is of the same text. Where lanes don't fall into step, as in one letter repeated, the rest is
        walked in order, each lane once."""
        begun = np.zeros(len(start), entries.dtype)  # the state each lane began in
        seams = np.flatnonzero(inner)
        for _ in range(ROUNDS):
            seams = seams[entries[start[seams] - 1] >> 2 != begun[seams]]
            if len(seams) <= FEW:
                break
            on, t, state = seams, 0, entries[start[seams] - 1] >> 2
            begun[seams] = state
            while len(on):
                at = start[on] + t
                entry = self.entry_after(lang, state, local[at])
                t += 1
                go = np.flatnonzero((entry >> 2 != entries[at] >> 2) & (t < size[on]))
                entries[at] = entry
                on, state = on[go], entry[go] >> 2
            seams = seams[seams + 1 < len(start)] + 1
            seams = seams[inner[seams]]
        for lane in seams.tolist():
            while lane < len(start) and inner[lane] and (state := entries[start[lane] - 1] >> 2) != begun[lane]:
                begun[lane] = state
                self.walk(lang, local, entries, int(start[lane]), int(size[lane]), int(state))
                lane += 1

    def walk(self, lang: int, local: np.ndarray, entries: np.ndarray, at: int, size: int, state: int) -> None:
        """One lane, a symbol at a time, until it is in the state it was in before."""
        table, width = self.tables[lang], self.widths[lang]
        for i, symbol, old in zip(range(at, at + size), local[at : at + size].tolist(), (entries[at : at + size] >> 2).tolist(), strict=True):
            entry = table.item(state + symbol) if symbol < width else int(self.entry_after(lang, np.array([state]), np.array([symbol]))[0])
            entries[i], state = entry, entry >> 2
            if state == old:
                return

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        phrases, symbols = self.parse(texts)
        bits = phrases * self.bits / np.maximum(symbols, 1)[:, None]
        best = bits.argmin(axis=1)
        weight = np.exp2(bits.min(axis=1)[:, None] - bits)
        some = symbols > 0
        return [self.names[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)], np.where(some, 1 / weight.sum(axis=1), 0.0)


def predict(docs: DataFrame, samples: dict[str, str], *, text_col: str = "text", keep: list[str | Column] = ("doc_id",)) -> DataFrame:
    """The kept columns, then lang_pred and score. One Arrow pass; each worker builds the automata once."""
    from .tokens import in_slices

    bounded_batches(docs.sparkSession)
    held, name = docs.sparkSession.sparkContext.broadcast(samples), uuid.uuid4().hex
    source = docs.select(*keep, F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("parsers")
        if name not in _parsers:
            _parsers.clear()
            _parsers[name] = Parser(held.value)
        for batch in batches:
            at = 0
            for part in in_slices(batch.column(batch.num_columns - 1).to_pylist(), lambda t: len(t or ""), SLICE_CHARS):
                langs, scores = _parsers[name].predict([t or "" for t in part])
                some = batch.slice(at, len(part))
                at += len(part)
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*some.schema.names[:-1], "lang_pred", "score"])

    from pyspark.sql import types as T

    schema = T.StructType([*source.schema.fields[:-1], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return source.mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score. Rows with crc32(doc_id) mod 5 = 0 are held out of fitting; a null id is not."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    samples = sample(docs, F.col("lang"), fold != 0)
    return predict(docs, samples, keep=["doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out")])
