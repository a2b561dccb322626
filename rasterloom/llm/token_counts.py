"""Edit-aware token counts.

A document is kept as a segment tree over its pre-tokens: leaves are short runs of pre-tokens (slots) with their text and the lengths
of the pre-tokens in characters and in tokens, inner nodes are sums. The count of a document is its root. An edit replaces characters
start..end by a text. Only the pre-tokens it touches are encoded again, plus boundary context: two pre-tokens before, and after
it as many as it takes until an old and a new boundary agree. The pattern never looks back, so everything beyond has the same
pre-tokens as before. Changed slots then update their sums on the way to the root; no other slot is looked at.

`build` makes a table of trees, a row per document: the text and its leaves, compressed (inner nodes are sums and are made again
when a tree is loaded). `edit` takes such a table and returns the table after the edits, so the next batch of edits starts from
stored trees and encodes its own regions only.

Cases: a null text counts as empty; a document with no edits keeps its count. Edits are applied in order, each to the text
that the ones before left; start and end are cut to the text (and end to start). A null replacement is empty, an edit that is null itself, or
has a null start or end, changes nothing. A text that spells an added token of the tokenizer is counted as the tokenizer counts it, and is encoded
whole after an edit. Rows are independent: repeated and null doc_ids get a row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_table, bounded_batches
from .tokens import PRETOKEN, PreTokens, in_slices, pretokens, tokenizer_path

SLOT = 64
SLICE_BYTES = 4 << 20
#: How far the pattern looks past the end of a match, in characters.
AHEAD = 2


class Tree:
    """A segment tree over slots of pre-tokens with two sums a node: characters and tokens. texts: the text of each slot."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.rebuild(text, chars, tokens)

    def rebuild(self, text: str, chars: np.ndarray, tokens: np.ndarray) -> None:
        cuts = range(0, len(chars), SLOT)
        self.slots = [(chars[i : i + SLOT], tokens[i : i + SLOT]) for i in cuts] or [(chars, tokens)]
        self.size = 1 << (len(self.slots) - 1).bit_length()
        self.sums = np.zeros((2 * self.size, 2), np.int64)
        if len(chars):
            at = np.arange(0, len(chars), SLOT)
            self.sums[self.size : self.size + len(at), 0] = np.add.reduceat(chars, at)
            self.sums[self.size : self.size + len(at), 1] = np.add.reduceat(tokens, at)
        ends = np.cumsum(self.sums[self.size : self.size + len(self.slots), 0]).tolist()
        self.texts = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        half = self.size
        while half > 1:
            half //= 2
            self.sums[half : 2 * half] = self.sums[2 * half : 4 * half].reshape(half, 2, 2).sum(axis=1)

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    def find(self, offset: int) -> tuple[int, int, int]:
        """(slot, pre-token in it, its start) of the pre-token that holds this character; the last one at the end of the text."""
        if not self.chars:
            return 0, 0, 0
        offset = min(offset, max(0, self.chars - 1))
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if offset >= before + self.sums[node, 0]:
                before += int(self.sums[node, 0])
                node += 1
        chars = self.slots[node - self.size][0]
        ends = before + np.cumsum(chars)
        i = int(np.searchsorted(ends, offset, side="right"))
        return node - self.size, i, int(ends[i] - chars[i])

    def ends_from(self, slot: int, at: int, start: int) -> Iterator[tuple[int, int, int]]:
        """(slot, index after, end) of the pre-tokens from here on."""
        while slot < len(self.slots):
            chars = self.slots[slot][0]
            for i in range(at, len(chars)):
                start += int(chars[i])
                yield slot, i + 1, start
            slot, at = slot + 1, 0

    def splice(self, first: tuple[int, int], last: tuple[int, int], text: str, chars: np.ndarray, tokens: np.ndarray) -> None:
        """Replaces the pre-tokens from `first` (slot, index) up to, without, `last`; sums are updated on their paths only. text: all
        that these slots hold afterwards."""
        (s, i), (e, j) = first, last
        head, tail = (x[:i] for x in self.slots[s]), (x[j:] for x in self.slots[e])
        merged = [np.concatenate(parts) for parts in zip(head, (chars, tokens), tail, strict=True)]
        for k in range(s, e + 1):
            self.slots[k], self.texts[k] = (chars[:0], tokens[:0]), ""
        self.slots[s], self.texts[s] = (merged[0], merged[1]), text
        if len(merged[0]) > 4 * SLOT:
            self.rebuild("".join(self.texts), *(np.concatenate([x[n] for x in self.slots]) for n in range(2)))
            return
        for k in range(s, e + 1):
            node = k + self.size
            self.sums[node] = self.slots[k][0].sum(), self.slots[k][1].sum()
            while node > 1:
                node //= 2
                self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]


class Document:
    """A text with its tree. encoded: how many pre-tokens have been encoded since it was built or loaded."""

    def __init__(self, text: str, coder: PreTokens, leaves: tuple[np.ndarray, np.ndarray] | None = None) -> None:
        self.coder, self.encoded = coder, 0
        if leaves is None:
            pieces = coder.pieces(text)
            leaves = np.fromiter(map(len, pieces), np.int64, len(pieces)), self.counts(pieces)
        self.tree = Tree(text, *leaves)

    def counts(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.coder.counts.__getitem__, pieces), np.int64, len(pieces))

    @property
    def text(self) -> str:
        return "".join(self.tree.texts)

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.concatenate([x[n] for x in self.tree.slots]) for n in range(2))

    def count(self) -> int:
        text = self.text
        if any(a in text for a in self.coder.added):
            return len(self.coder.encode([text])[0]) // 4
        return self.tree.tokens

    def edit(self, start: int, end: int, new: str) -> None:
        tree, size = self.tree, self.tree.chars
        start = min(max(0, start), size)
        end = min(max(start, end), size)
        grown = len(new) - (end - start)
        # The pattern looks at most AHEAD characters past the end of a match: only the pre-token that holds the character
        # before the edit, and the one before that, can change. One more is encoded again for safety.
        slot, i, at = tree.find(max(0, start - 1))
        for _ in range(2):
            if at > 0:
                slot, i, at = tree.find(at - 1)
        begin = at - int(tree.slots[slot][0][:i].sum())  # where the slot begins; positions below count from there
        last, wide = slot, 1
        while True:  # a window of slots, widened until boundaries agree inside it
            while last < len(tree.texts) and (wide > 0 or begin + sum(map(len, tree.texts[slot:last])) < end):
                last, wide = last + 1, wide - 1
            old = "".join(tree.texts[slot:last])
            now = old[: start - begin] + new + old[end - begin :]
            whole = begin + len(old) == size
            found = self.agree(now, at - begin, start - begin, end - begin, len(new), grown, whole, tree.ends_from(slot, i, at), begin)
            if found:
                break
            wide = 2 * (last - slot)
        pieces, (e, j, stop) = found
        if e < 0:
            e, j, stop = len(tree.slots) - 1, len(tree.slots[-1][0]), size
        self.encoded += len(pieces)
        past = begin + sum(map(len, tree.texts[slot : e + 1]))  # where slot e ended
        tree.splice((slot, i), (e, j), now[: past - begin + grown], np.fromiter(map(len, pieces), np.int64, len(pieces)), self.counts(pieces))

    @staticmethod
    def agree(now: str, at: int, start: int, end: int, added: int, grown: int, whole: bool, ends: Iterator[tuple[int, int, int]], begin: int) -> tuple[list[str], tuple[int, int, int]] | None:
        """The new pre-tokens of a window from `at` on, up to the first old boundary (slot, index, place) that is a new one too; slot -1 is
        the end of the text. None if there is no such boundary for sure inside the window."""
        pieces, stop = [], (0, 0, -1)
        for m in PRETOKEN.finditer(now, at):
            if not whole and m.end() + AHEAD > len(now):
                return None
            pieces.append(m.group())
            same = m.end() - grown  # where this character was
            if m.end() >= start + added:
                while stop[2] < same:
                    slot, j, place = next(ends, (-1, 0, -1))
                    if slot < 0:
                        break
                    stop = slot, j, place - begin
                if stop[2] == same >= end:  # the matches from here on depend on the text from here on, which is as it was
                    return pieces, stop
        return (pieces, (-1, 0, 0)) if whole else None


def packed(chars: np.ndarray, tokens: np.ndarray) -> bytes:
    """Leaves as compressed planes: lengths, then counts, each a byte wide if all of them fit, else four."""
    wide = [a.astype(np.uint8 if a.max(initial=0) < 256 else "<u4") for a in (chars, tokens)]
    return bytes([a.itemsize for a in wide]) + zstandard.compress(b"".join(a.tobytes() for a in wide), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes, (one, two) = zstandard.decompress(data[2:]), data[:2]
    n = len(planes) // (one + two)
    return tuple(np.frombuffer(planes, np.uint8 if width == 1 else "<u4", n, offset).astype(np.int64) for width, offset in ((one, 0), (two, n * one)))


TREES = "doc_id long, text string, leaves binary, n_pretokens long, n_tokens long"
RESULT = "tokens_before long, n_encoded long"
EDITS = "array<struct<start:int,end:int,text:string>>"


def tree_row(doc_id: int | None, d: Document) -> tuple:
    leaves = d.leaves()
    return doc_id, d.text, packed(*leaves), len(leaves[0]), d.count()


def as_batch(rows: list[tuple], more: tuple[str, ...] = ()) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.binary(), *[pa.int64()] * (2 + len(more))]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "text", "leaves", "n_pretokens", "n_tokens", *more])


def build(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """TREES: a tree per row of docs. The only pass that encodes whole texts."""
    bounded_batches(docs.sparkSession)
    path = tokenizer or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pretokens(path)
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            for part in in_slices(rows, lambda r: len(r[1] or ""), SLICE_BYTES):
                yield as_batch([tree_row(doc, Document(text or "", coder)) for doc, text in part])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, TREES)


def edit(trees: DataFrame, edits: Column, *, tokenizer: str | None = None) -> DataFrame:
    """TREES after the edits, with tokens_before and n_encoded (pre-tokens encoded for the edits).

    edits: array<struct<start int, end int, text string>> of the row, offsets in characters."""
    bounded_batches(trees.sparkSession)
    path = tokenizer or tokenizer_path()
    source = trees.select("doc_id", "text", "leaves", "n_tokens", edits.cast(EDITS).alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pretokens(path)
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            for part in in_slices(rows, lambda r: len(r[1]), SLICE_BYTES):
                out = []
                for doc, text, leaves, before, changes in part:
                    d = Document(text, coder, unpacked(leaves))
                    for e in changes or ():
                        if e is not None and e["start"] is not None and e["end"] is not None:
                            d.edit(e["start"], e["end"], e["text"] or "")
                    out.append((*tree_row(doc, d), before, d.encoded))
                yield as_batch(out, ("tokens_before", "n_encoded"))

    return source.mapInArrow(run, f"{TREES}, {RESULT}")


#: What the query does to each document: a line in front, a replacement in the middle, a cut, and a line at the end.
HEADER, MIDDLE, FOOTER = "Revised copy.\n", " [amended]", "\nEnd of document."


def sample_edits(text: Column) -> Column:
    n, head = F.coalesce(F.length(text), F.lit(0)), len(HEADER)
    half, third = (n / 2).cast("int"), (n / 3).cast("int")
    # Offsets are those at the time of each edit: the header has moved the text, later places lie before earlier ones.
    return F.array(
        F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(HEADER).alias("text")),
        F.struct((n + head).alias("start"), (n + head).alias("end"), F.lit(FOOTER).alias("text")),
        F.struct((half + head).alias("start"), (F.least(half + 7, n) + head).alias("end"), F.lit(MIDDLE).alias("text")),
        F.struct((third + head).alias("start"), (F.least(third + 12, half) + head).alias("end"), F.lit("").alias("text")),
    )


def count_all(docs: DataFrame) -> DataFrame:
    """doc_id, tokens_before, tokens_after, n_pretokens (after), n_encoded: trees of all documents are built and stored, then edited."""
    done = edit(as_table(build(docs), "trees", "zstd"), sample_edits(F.col("text")))
    return done.select("doc_id", "tokens_before", F.col("n_tokens").alias("tokens_after"), "n_pretokens", "n_encoded")
