"""Text quality by naive Bayes support vectors: n-gram indicators scaled by log-count ratios under a linear hinge-loss model."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import fold, labelled_sample, logistic, sigmoid
from .wordbytes import mixed, segment_hash, slices, split_words, word_hashes

#: Labelled documents of each class that the model is fitted on, at most.
PER_CLASS = 2000
FOLDS, HELD_FOLD = 4, 2
THRESHOLD = 0.7
_BITS = 20

# Classes of bytes in a word's shape: capitals, small letters and all beyond ASCII, digits; every other sign is its own.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91] = 1
_CLASS[97:123] = 2
_CLASS[128:] = 2
_CLASS[48:58] = 3


@dataclass
class Model:
    #: For each n-gram, its log-count ratio times its weight.
    weights: np.ndarray
    document: np.ndarray


def _gram(parts: list[np.ndarray], kind: int) -> np.ndarray:
    h = np.full(len(parts[0]), (0xA24BAED4963EE407 * (kind + 1)) % 2**64, np.uint64)
    for x in parts:
        h = mixed(h ^ x)
    return h >> np.uint64(64 - _BITS)


def indicators(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """N-grams that occur in each text, as (text, n-gram) sorted by text, each pair once.

    N-grams of one and two words, and of one to three shapes of words. A shape is the word's runs of capitals, small letters
    and digits and its other signs, and whether the word is the same as one of the three before it. The power of two of a
    text's number of words counts as one more word.
    """
    words = split_words(texts)
    n = len(words.starts)
    counts = np.diff(words.first)
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), counts)
    size = np.ceil(np.log2(counts + 1)).astype(np.uint64)
    found = [(np.arange(len(texts), dtype=np.int64) << _BITS) | _gram([size], 9).astype(np.int64)]
    if n:
        word = word_hashes(words)
        lengths = words.ends - words.starts
        kinds = _CLASS[words.data[words.inside]]
        offsets = np.cumsum(lengths) - lengths
        turn = np.ones(len(kinds), bool)
        turn[1:] = kinds[1:] != kinds[:-1]
        turn[offsets] = True
        shape = segment_hash(kinds[turn], np.add.reduceat(turn.astype(np.int64), offsets))
        place = np.arange(n) - np.repeat(words.first[:-1], counts)
        again = np.zeros(n, np.uint64)
        for back in (3, 2, 1):
            same = np.flatnonzero((word[back:] == word[:-back]) & (place[back:] >= back)) + back
            again[same] = back
        shape = mixed(shape + again)
        for kind, (base, length) in enumerate(((word, 1), (word, 2), (shape, 1), (shape, 2), (shape, 3))):
            ends = np.flatnonzero(place >= length - 1)
            grams = _gram([base[ends - k] for k in range(length)], kind)
            found.append((doc[ends] << _BITS) | grams.astype(np.int64))
    keys = np.sort(np.concatenate(found))
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return keys >> _BITS, keys & ((1 << _BITS) - 1)


def log_count_ratios(doc: np.ndarray, gram: np.ndarray, y: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """The logarithm of the n-gram's share of all indicators of class 1 over that of class 0."""
    good = np.bincount(gram[y[doc] == 1], minlength=1 << _BITS) + smoothing
    bad = np.bincount(gram[y[doc] == 0], minlength=1 << _BITS) + smoothing
    ratio = np.log((good / good.sum()) / (bad / bad.sum()))
    # n-grams that were never seen say nothing
    ratio[(good == smoothing) & (bad == smoothing)] = 0
    return ratio


def dual_coordinate_descent(
    begins: np.ndarray, gram: np.ndarray, value: np.ndarray, y: np.ndarray, cost: float = 1.0, epochs: int = 20, seed: int = 3
) -> np.ndarray:
    """Weights, the constant last, that minimise |w|^2 / 2 + cost * sum of max(0, 1 - y w.x); y is 1 or -1.

    One dual variable, between 0 and cost, is set to its best value at a time, and the weights follow.
    """
    rng = np.random.Generator(np.random.PCG64(seed))
    w, constant = np.zeros(1 << _BITS), 0.0
    rows = [(gram[a:b], value[a:b]) for a, b in zip(begins[:-1], begins[1:], strict=True)]
    curve = [float(v @ v) + 1.0 for _, v in rows]
    alpha = np.zeros(len(rows))
    for _ in range(epochs):
        largest = 0.0
        for i in rng.permutation(len(rows)):
            at, v = rows[i]
            gradient = y[i] * (w[at] @ v + constant) - 1.0
            new = min(max(alpha[i] - gradient / curve[i], 0.0), cost)
            step = (new - alpha[i]) * y[i]
            if step:
                w[at] += step * v
                constant += step
                largest = max(largest, abs(step))
            alpha[i] = new
        if largest < 1e-4:
            break
    return np.append(w, constant)


def margins(doc: np.ndarray, gram: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    """w.x of each text; x is the scaled indicators over the root of their number."""
    total = np.bincount(doc, weights[gram], n)
    return total / np.sqrt(np.maximum(np.bincount(doc, minlength=n), 1)) + weights[-1]


def fit(texts: list[bytes], y: np.ndarray, weight: np.ndarray) -> Model:
    """Two thirds of the documents fit the hinge-loss model, all others the step from margins to probabilities."""
    if len(set(y.tolist())) < 2:
        return Model(np.zeros((1 << _BITS) + 1, np.float32), np.array([0.0, 20.0 if len(y) and y[0] == 1 else -20.0]))
    part = np.arange(len(texts)) % 3 != 0
    doc, gram = indicators([t for t, k in zip(texts, part, strict=True) if k])
    own = y[part]
    ratio = log_count_ratios(doc, gram, own)
    begins = np.searchsorted(doc, np.arange(len(own) + 1))
    value = ratio[gram] / np.sqrt(np.diff(begins))[doc]
    solved = dual_coordinate_descent(begins, gram, value, 2.0 * own - 1.0)
    weights = np.append(solved[:-1] * ratio, solved[-1])
    rest = [t for t, k in zip(texts, part, strict=True) if not k]
    x = margins(*indicators(rest), len(rest), weights)
    return Model(weights.astype(np.float32), logistic(x[:, None], y[~part], weight[~part]))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, folds: int = FOLDS, held_fold: int = HELD_FOLD) -> Model:
    """The model of the documents that `labels.quality` marks and that aren't held out."""
    return fit(*labelled_sample(docs, labels, "quality", fold("doc_id", folds) == held_fold, per_class))


def score_texts(texts: list[bytes], model: Model) -> np.ndarray:
    x = margins(*indicators(texts), len(texts), model.weights)
    return sigmoid(x * model.document[0] + model.document[1])


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one for each row of docs.

    docs: columns doc_id, text; labels: doc_id, quality; others are not read. The model learns from a bounded sample of the
    labelled documents that aren't held out (PER_CLASS of each class); it sees nothing but the text. Null and empty texts
    score as texts of no words. held_out is null for a null doc_id. Without labels of both classes every text gets the same
    score. An empty table gives no rows.
    """
    model = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            score = score_texts(texts, model)
            predicted = pa.array((score >= THRESHOLD).astype(np.int32))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(score), predicted], ["doc_id", "score", "predicted"])

    scored = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, score double, predicted int")
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD_FOLD).alias("held_out"), "score", "predicted")
