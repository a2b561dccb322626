"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear (logistic) models; each later model gets the probabilities of the earlier
categories as further inputs. In training those inputs are out-of-fold predictions, so a later model sees earlier ones as good
as they will be on new text, not as they are on text they were fitted to. All that a fold's model is made of, its choice of inputs
too, comes from the other folds; equal texts are in one fold.

Inputs: which words a text holds, the first three to six letters of each word (which carries over to forms not seen in training),
and its share of signs and digits, its length and its repetition in steps. They are chosen for each category by how much more often they
occur in texts that have it, and in those that don't.

What is fitted: at most about `rows` labelled ids for each combination of categories and `most_bytes` of text in all (the text that
reaches it is the last), chosen by a hash of the id and weighted back to their true share; the labels are counted in full. An id
on several rows gives one text. Rows are predicted from their whole text.

Cases: a null or empty text has no words and gets the model's base rate. Documents without labels are predicted all the same. A
label row with a null id, or null in any category, isn't used; several label rows of one id count as the most severe. If nothing is
labelled, or all labels of a category agree, its probability is their mean (0 without labels). Rows with a null doc_id, and
repeated rows, are predicted like any other.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM_WORDS, cache, row_pass, struct_of_all, text_bytes

SAMPLE_ROWS = 2000
SAMPLE_BYTES = 64 << 20
FEATURES = 1000
FOLDS = 4
PREFIXES = (3, 4, 5, 6)
LEAST_DOCUMENTS = 5
#: Ridge penalty of a model, divided by the number of rows it is fitted to.
PENALTY = 0.2
STEPS = 300
THRESHOLD = 0.3
CACHE_WORDS = 150_000

SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
DIGITS = b"0123456789"
SHARES = (0.005, 0.02, 0.05, 0.1, 0.2, 0.4)
LENGTHS = (5, 20, 60, 200, 1000, 5000)

_models: dict[str, Chain] = {}
cache("toxicity", _models.clear)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(ALNUM_WORDS).split() if text else []


def number(feature: bytes) -> int:
    """32 bits of hash stand for a feature."""
    return xxhash.xxh32_intdigest(feature)


def features_of_word(word: bytes) -> list[int]:
    """Numbers of the word and its beginnings, whole UTF-8 letters only."""
    letters = word.decode(errors="replace")
    return [number(word), *(number(b"^" + letters[:n].encode()) for n in PREFIXES if len(letters) >= n)]


def shape(text: bytes | None, words: list[bytes], distinct: set[bytes]) -> list[int]:
    """Steps reached by the shares of signs and digits, by length and by repetition."""
    size = max(1, len(text or b""))
    signs, digits = (1 - len((text or b"").translate(None, delete=d)) / size for d in (SIGNS, DIGITS))
    repeated = 1 - len(distinct) / max(1, len(words))
    out = [b"=%s>%d" % (name, i) for name, x in ((b"signs", signs), (b"digits", digits), (b"repeats", repeated)) for i, s in enumerate(SHARES) if x >= s]
    return [*map(number, out), *(number(b"=words>%d" % i) for i, n in enumerate(LENGTHS) if len(words) >= n)]


def held_features(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct features of each text."""
    out, known = [], {}
    for t in texts:
        words = words_of(t)
        distinct = set(words)
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in distinct:
            if w not in known:
                known[w] = features_of_word(w)
        out.append(np.unique(np.array([f for w in distinct for f in known[w]] + shape(t, words, distinct), np.uint32)))
    return out


def chosen_features(held: list[np.ndarray], y: np.ndarray, most: int) -> np.ndarray:
    """The features whose share of texts differs most between those with the category and those without, sorted."""
    # One side at a time, sorted and counted, so that only half of all features are copied at once.
    (with_it, a), (without, b) = (np.unique(np.concatenate([f for f, label in zip(held, y, strict=True) if (label > 0) == side]), return_counts=True) for side in (True, False))
    names = np.union1d(with_it, without)
    a, b = (np.bincount(np.searchsorted(names, own), n, len(names)) for own, n in ((with_it, a), (without, b)))
    p, q = a / (y > 0).sum(), b / (y == 0).sum()
    mean = (p + q) / 2
    score = np.where(a + b >= LEAST_DOCUMENTS, np.abs(p - q) / np.sqrt((mean + 1e-4) * (1 - mean) + 1e-6), 0)
    best = np.lexsort((names, -score))[:most]
    return np.sort(names[best[score[best] > 0]])


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> np.ndarray:
    """Weights, the intercept last, by accelerated gradient steps on the weighted, penalised loss."""
    penalty /= len(x)
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weight = (weight / weight.sum()).astype(x.dtype)
    y = y.astype(x.dtype)
    v = np.ones(x.shape[1], x.dtype)
    for _ in range(20):  # the largest curvature, by power iteration
        v = x.T @ (weight * (x @ v))
        top = float(np.linalg.norm(v))
        v /= top
    rate = 1 / (top / 4 + penalty)
    w = ahead = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 0
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead.astype(x.dtype), -30, 30)))
        new = ahead - rate * (x.T @ (weight * (p - y)) + ridge * ahead)
        ahead, w = new + k / (k + 3) * (new - w), new
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


@dataclass
class Link:
    """One model of the chain. Without features it predicts the intercept's rate."""

    features: dict[int, int]
    weights: np.ndarray
    constant: float | None = None


@dataclass
class Chain:
    names: list[str]
    links: list[Link]
    known: dict[bytes, tuple[tuple[int, int], ...]] = field(default_factory=dict)

    def inputs_of(self, word: bytes) -> tuple[tuple[int, int], ...]:
        """(link, input) pairs that a word sets; kept in a bounded cache."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            found = self.known[word] = tuple((i, link.features[f]) for f in features_of_word(word) for i, link in enumerate(self.links) if f in link.features)
        return found

    def predict(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """A probability array per category."""
        set_inputs: list[tuple[list[int], list[int]]] = [([], []) for _ in self.links]
        for row, text in enumerate(texts):
            words = words_of(text)
            distinct = set(words)
            mine = {x for w in distinct for x in self.inputs_of(w)}
            mine.update((i, link.features[f]) for f in shape(text, words, distinct) for i, link in enumerate(self.links) if f in link.features)
            for i, column in mine:
                set_inputs[i][0].append(row)
                set_inputs[i][1].append(column)
        out: list[np.ndarray] = []
        for link, (rows, columns) in zip(self.links, set_inputs, strict=True):
            if link.constant is not None:
                out.append(np.full(len(texts), link.constant))
                continue
            n = len(link.features)
            z = np.bincount(np.array(rows, np.int64), link.weights[np.array(columns, np.int64)], len(texts)) + link.weights[-1]
            for earlier, w in zip(out, link.weights[n:-1], strict=True):
                z += earlier * w
            out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return out


def inputs(held: list[np.ndarray], chosen: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    """A row per text: 0 or 1 for each chosen feature, then the earlier categories' probabilities."""
    x = np.zeros((len(held), len(chosen) + earlier.shape[1]), np.float32)
    for row, f in enumerate(held):
        x[row, np.flatnonzero(np.isin(chosen, f, assume_unique=True))] = 1
    x[:, len(chosen) :] = earlier
    return x


def out_of_fold(held: list[np.ndarray], y: np.ndarray, weight: np.ndarray, earlier: np.ndarray, fold: np.ndarray, features: int) -> np.ndarray:
    """For each text, the prediction of a model whose features and weights come from the other folds only."""
    unseen = np.empty(len(held))
    for k in np.unique(fold):
        here, there = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        seen = y[there]
        if not len(seen) or seen.min() == seen.max():
            unseen[here] = seen.mean() if len(seen) else y.mean()
            continue
        chosen = chosen_features([held[i] for i in there], seen, features)
        w = fit_logistic(inputs([held[i] for i in there], chosen, earlier[there]), seen, weight[there])
        unseen[here] = probability(inputs([held[i] for i in here], chosen, earlier[here]), w)
    return unseen


def fit_chain(texts: list[bytes], labels: np.ndarray, weight: np.ndarray, names: Sequence[str], *, features: int = FEATURES, folds: int = FOLDS) -> Chain:
    """labels: a row per text, a column (0/1) per category, in the chain's order."""
    held = held_features(texts)
    fold = np.array([number(t) % folds for t in texts], int)
    links: list[Link] = []
    earlier = np.empty((len(texts), 0))
    for c in range(len(names)):
        y = labels[:, c].astype(float)
        if not len(y) or y.min() == y.max():
            links.append(Link({}, np.zeros(earlier.shape[1] + 1), float(y.mean()) if len(y) else 0.0))
            earlier = np.column_stack([earlier, np.full(len(texts), links[-1].constant)])
            continue
        chosen = chosen_features(held, y, features)
        links.append(Link({f: i for i, f in enumerate(chosen.tolist())}, fit_logistic(inputs(held, chosen, earlier), y, weight)))
        if c + 1 < len(names):  # later models are fitted to predictions of models that haven't seen the row
            earlier = np.column_stack([earlier, out_of_fold(held, y, weight, earlier, fold, features)])
    return Chain(list(names), links)


def sample(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], *, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts, labels and weights of a bounded sample. Only ids and labels are gathered before the sample is drawn."""
    names = list(categories)
    known = labels.where(F.col("doc_id").isNotNull()).select("doc_id", *(c.cast("int").alias(n) for n, c in categories.items())).na.drop()
    known = known.groupBy("doc_id").agg(*(F.max(n).alias(n) for n in names))
    counts = {tuple(r)[:-1]: r[-1] for r in known.groupBy(*names).count().collect()}  # two to the number of categories, at most
    if not counts:
        return [], np.empty((0, len(names))), np.empty(0)
    share = F.lit(0.0)
    for combination, n in counts.items():
        share = F.when(F.array(*names) == F.array(*map(F.lit, combination)), F.lit(rows / n)).otherwise(share)
    unit = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    drawn = known.where(unit < share)  # about `rows` ids a combination
    # By id before any row leaves its task: an id may be on any number of rows.
    once = docs.where("text is not null").join(F.broadcast(drawn), "doc_id").groupBy("doc_id", *names).agg(F.min_by(text_bytes("text"), F.xxhash64("text")).alias("text"))
    texts, y, held = [], [], 0
    for r in once.orderBy(F.xxhash64("doc_id")).select("text", *names).toLocalIterator():
        texts.append(bytes(r[0]))
        y.append(tuple(r)[1:])
        held += len(texts[-1])
        if held >= most_bytes:
            break
    drawn_counts = Counter(y)
    weight = np.array([counts[k] / drawn_counts[k] for k in y]) if y else np.empty(0)
    return texts, np.array(y).reshape(-1, len(names)), weight


def score(docs: DataFrame, chain: Chain, keep: Column | None = None) -> DataFrame:
    """row (all columns of docs, or keep) and out: p_<category> for each."""
    keep = struct_of_all(docs) if keep is None else keep
    held, name = docs.sparkSession.sparkContext.broadcast(chain), uuid.uuid4().hex
    out = T.StructType([T.StructField(f"p_{n}", T.DoubleType()) for n in chain.names])

    def predict(texts: list[bytes | None]) -> dict[str, pa.Array]:
        if name not in _models:
            _models.clear()
            _models[name] = held.value
        parts = [_models[name].predict(texts[i : i + 1000]) for i in range(0, len(texts), 1000)]
        return {f.name: pa.array(np.concatenate([p[i] for p in parts] or [np.empty(0)]), pa.float64()) for i, f in enumerate(out.fields)}

    return row_pass(docs, text_bytes("text"), keep, predict, out, ("toxicity",))


def categories() -> dict[str, Column]:
    """The chain's order: low quality first, then toxic."""
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}


def detect(docs: DataFrame, labels: DataFrame, keep: Column | None = None) -> DataFrame:
    texts, y, weight = sample(docs, labels, categories())
    return score(docs, fit_chain(texts, y, weight, list(categories())), keep)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, p_low_quality, p_toxic, toxic."""
    return detect(docs, labels, F.struct("doc_id")).select("row.doc_id", "out.p_low_quality", "out.p_toxic", (F.col("out.p_toxic") >= THRESHOLD).alias("toxic"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that aren't toxic, columns unchanged."""
    return detect(docs, labels).where(F.col("out.p_toxic") < THRESHOLD).select("row.*")
