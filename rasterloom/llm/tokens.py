"""Token ids by a public byte-level BPE, read from a tokenizers file.

Whole texts go through a rank merger that is built from the file's own vocabulary, where that is sure to give the same ids
(merges in the order of their ids); all else goes through the tokenizers library itself."""

from __future__ import annotations

import array
import json

import regex

from .common import cache, enter

#: fixed value: the pre-token pattern of byte-level BPE (public).
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
TOKENIZER = "byte_bpe_50k.json"
CACHE_ENTRIES = 500_000
#: Texts with a run of this length without a blank are left to the tokenizers library: the rank merger is quadratic in it.
LONG_RUN = 2000

_loaded: dict[str, PreTokens] = {}
cache("tokens", _loaded.clear)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceCounts(dict):
    """The number of ids by pre-token, counted when first asked for. It starts anew when full, so that memory stays bounded."""

    def __init__(self, coder: PreTokens, entries: int) -> None:
        super().__init__()
        self.coder, self.entries = coder, entries

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.entries:
            self.clear()
        n = self[piece] = self.coder.count_piece(piece)
        return n


class PreTokens:
    """Ids of whole texts as little-endian uint32 bytes. Equal to Tokenizer.encode(text, add_special_tokens=False)."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        self.added = [a["content"] for a in described["added_tokens"]]
        self.ranks = rank_merger(described["model"], set(self.added))
        self.counts = PieceCounts(self, entries)

    def pieces(self, text: str) -> list[str]:
        return PRETOKEN.findall(text)

    def count_piece(self, piece: str) -> int:
        """The number of ids of one pre-token."""
        if self.ranks is None or len(piece) >= LONG_RUN:
            return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        return len(self.ranks.encode_ordinary(piece))

    def encode(self, texts: list[str]) -> list[bytes]:
        """One value per text. Texts that spell an added token, or hold a very long run, go to the tokenizers library."""
        out: list[bytes] = []
        for t in texts:
            if self.ranks is None or any(a in t for a in self.added) or has_long_run(t):
                out.append(array.array("I", self.tokenizer.encode(t, add_special_tokens=False).ids).tobytes())
            else:
                out.append(self.ranks.encode_to_numpy(t, disallowed_special=()).tobytes())
        return out


def has_long_run(text: str) -> bool:
    """Whether a block of half that length, of those the text is divided into, has no blank."""
    half = LONG_RUN // 2
    return any(text.find(" ", p, p + half) < 0 for p in range(0, len(text) - half + 1, half))


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in such files: printable bytes for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def rank_merger(model: dict, added: set[str]):
    """A merger by rank with the ids of this vocabulary, or None if ranks and merges might differ."""
    import tiktoken

    letters, vocab = byte_letters(), model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocab.get("".join(m)) for m in merges]
    if None in ids or ids != sorted(set(ids)):
        return None
    ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in added}
    if len(ranks) != 256 + len(merges) or sorted(ranks[bytes([b])] for b in range(256)) != list(range(256)):
        return None
    return tiktoken.Encoding("own", pat_str=PRETOKEN.pattern, mergeable_ranks=ranks, special_tokens={})


def pretokens(path: str) -> PreTokens:
    """The worker's coder for a tokenizer file."""
    enter("tokens")
    if path not in _loaded:
        _loaded[path] = PreTokens(path)
    return _loaded[path]


def in_slices(values: list, weight, most: int):
    """Consecutive slices of values with a total weight of about most: bounds what a worker holds at once."""
    start, total = 0, 0
    for i, v in enumerate(values):
        total += weight(v)
        if total >= most:
            yield values[start : i + 1]
            start, total = i + 1, 0
    if start < len(values):
        yield values[start:]
