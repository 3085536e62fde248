"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labelled import fold, labelled_sample, logistic, sigmoid
from .wordbytes import mixed, slices, split_words

#: Labelled documents of each class that the model is fitted on, at most.
PER_CLASS = 2000
FOLDS, HELD_FOLD = 5, 0
THRESHOLD = 0.5
#: Longer sentences are several chains.
CHAIN = 64
_BITS = 18
_NOTHING = 1 << _BITS
_PREFIXES = (4, 5, 6, 8)
_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n\r")] = True


@dataclass
class Model:
    weights: np.ndarray
    #: Weights of the start in a toxic token, and of the steps clean-toxic, toxic-clean, toxic-toxic.
    steps: np.ndarray
    document: np.ndarray


@dataclass
class Tokens:
    """Tokens of many texts; text k has first[k]:first[k + 1], chain c begins at chains[c]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    chains: np.ndarray
    features: np.ndarray


def _index(values: np.ndarray, kind: int) -> np.ndarray:
    return (mixed(values + np.uint64(0x9E3779B97F4A7C15 * (kind + 1) % 2**64)) >> np.uint64(64 - _BITS)).astype(np.int32)


def tokens_of(texts: list[bytes]) -> Tokens:
    """Runs of letters and digits, in lower case. Features: word, prefixes, suffix, the words before and after."""
    words = split_words(texts, lower=True, separators=~_TOKEN)
    starts, ends = words.starts, words.ends
    n, lengths = len(starts), ends - starts
    padded = np.concatenate([words.data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(words.data) + 1,), "<u8", padded, strides=(1,))
    masks = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
    head = eight[starts] & masks[np.minimum(lengths, 8)]
    long = lengths > 8
    tail = np.where(long, eight[np.maximum(ends - 8, 0)], np.uint64(0))
    word = mixed(head + mixed(tail + lengths.astype(np.uint64)))
    features = np.full((3 + len(_PREFIXES) + 1, n), _NOTHING, np.int32)
    features[0] = _index(word, 0)
    ended = np.cumsum(_ENDS[words.data], dtype=np.int32)[starts]
    new = np.ones(n, bool)
    new[1:] = ended[1:] != ended[:-1]
    begins = np.flatnonzero(new)
    if n:
        within = np.arange(n) - np.repeat(begins, np.diff(np.append(begins, n)))
        new |= within % CHAIN == 0
        begins = np.flatnonzero(new)
        inner = ~new[1:]
        features[1, 1:][inner] = _index(word[:-1], 1)[inner]
        features[2, :-1][inner] = _index(word[1:], 2)[inner]
    for k, size in enumerate(_PREFIXES):
        has = lengths > size
        features[3 + k, has] = _index(head[has] & masks[size], 3 + k)
    has = lengths > 4
    features[-1, has] = _index(eight[np.maximum(ends[has] - 4, 0)] & masks[4], 9)
    return Tokens(words.data, starts, ends, words.first, begins, features)


def _layout(chains: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings of the chains, longest first, and how many have more than t tokens."""
    lengths = np.diff(np.append(chains, n))
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max()) if len(lengths) else 0
    active = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
    return chains[order], active


def forward_backward(scores: np.ndarray, chains: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ratios toxic to clean of the forward and the backward messages of every token, and its own factor.

    Both labels' messages are only needed up to a common factor, so one ratio a token is enough. Chains run side by side.
    """
    factor = np.exp(np.clip(scores, -30, 30))
    m01, m10, m11 = np.exp(steps[1:])
    forward, backward = np.empty(len(scores)), np.ones(len(scores))
    begins, active = _layout(chains, len(scores))
    for t, n in enumerate(active):
        at = begins[:n] + t
        if t == 0:
            forward[at] = factor[at] * np.exp(steps[0])
        else:
            before = forward[at - 1]
            forward[at] = factor[at] * (m01 + m11 * before) / (1 + m10 * before)
    for t in range(len(active) - 2, -1, -1):
        at = begins[: active[t + 1]] + t
        after = factor[at + 1] * backward[at + 1]
        backward[at] = (m10 + m11 * after) / (1 + m01 * after)
    return forward, backward, factor


def marginals(tokens: Tokens, weights: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The probability of every token to be toxic."""
    scores = weights[tokens.features].sum(axis=0, dtype=np.float64)
    forward, backward, _ = forward_backward(scores, tokens.chains, steps)
    both = forward * backward
    return both / (1 + both)


def token_labels(tokens: Tokens, toxic: np.ndarray) -> np.ndarray:
    """Labels of the tokens of labelled documents: in toxic ones, those whose word or prefix is far more usual in toxic ones.

    That is: in three toxic documents or more, its share of toxic documents is 7 times that of clean ones, and the
    likelihood ratio of the two shares speaks clearly against chance.
    """
    doc = np.repeat(np.arange(len(toxic)), np.diff(tokens.first))
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    out = np.zeros(len(doc), bool)
    for row in (0, *range(4, 3 + len(_PREFIXES))):
        feature = tokens.features[row].astype(np.int64)
        pairs = np.unique(doc * (_NOTHING + 1) + feature)
        d, f = pairs // (_NOTHING + 1), pairs % (_NOTHING + 1)
        a = np.bincount(f[toxic[d]], minlength=_NOTHING + 1)
        b = np.bincount(f[~toxic[d]], minlength=_NOTHING + 1)
        expected = (a + b) / (n1 + n0)
        with np.errstate(divide="ignore", invalid="ignore"):
            g = 2 * (np.where(a > 0, a * np.log(a / (n1 * expected)), 0) + np.where(b > 0, b * np.log(b / (n0 * expected)), 0))
        usual = (a >= 3) & ((a + 0.5) / (n1 + 1) > 7 * (b + 0.5) / (n0 + 1)) & (g > 12)
        usual[_NOTHING] = False
        out |= usual[feature]
    return out & toxic[doc]


def fit_tokens(tokens: Tokens, labels: np.ndarray, epochs: int = 4, batch: int = 8192, rate: float = 0.3, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Weights by stochastic gradients of the chains' log-likelihood, with a rate for each weight."""
    rng = np.random.Generator(np.random.PCG64(seed))
    weights, size = np.zeros(_NOTHING + 1), np.full(_NOTHING + 1, 1e-6)
    steps, step_size = np.array([-3.0, -3.0, 0.0, 0.0]), np.full(4, 1e-6)
    lengths = np.diff(np.append(tokens.chains, len(labels)))
    y = labels.astype(np.float64)
    for _ in range(epochs):
        order = rng.permutation(len(tokens.chains))
        for cut in np.array_split(order, max(1, int(lengths.sum()) // batch)):
            n = lengths[cut]
            begins = np.cumsum(n) - n
            at = np.arange(int(n.sum())) + np.repeat(tokens.chains[cut] - begins, n)
            features, truth = tokens.features[:, at], y[at]
            scores = weights[features].sum(axis=0)
            forward, backward, factor = forward_backward(scores, begins, steps)
            both = forward * backward
            error = both / (1 + both) - truth
            gradient = np.bincount(features.ravel(), np.tile(error, len(features)), _NOTHING + 1)
            gradient += 1e-4 * weights
            gradient[_NOTHING] = 0
            size += gradient**2
            weights -= rate * gradient / np.sqrt(size)
            inner = np.ones(len(at), bool)
            inner[begins] = False
            t = np.flatnonzero(inner)
            after = factor[t] * backward[t]
            m01, m10, m11 = np.exp(steps[1:])
            cells = np.stack([np.ones(len(t)), m01 * after, forward[t - 1] * m10, forward[t - 1] * m11 * after])
            cells /= cells.sum(axis=0)
            seen = np.array([((1 - truth[t - 1]) * truth[t]).sum(), (truth[t - 1] * (1 - truth[t])).sum(), (truth[t - 1] * truth[t]).sum()])
            push = np.concatenate([[error[begins].sum()], cells[1:].sum(axis=1) - seen])
            step_size += push**2
            steps -= 0.1 * push / np.sqrt(step_size)
    return weights, np.clip(steps, -12, 12)


def _document_features(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each text: its most toxic token's log-odds, the expected number of toxic tokens, and that number a thousand tokens."""
    n = np.diff(first)
    best, total = np.zeros(len(n)), np.zeros(len(n))
    some = np.flatnonzero(n)
    if len(some):
        best[some] = np.maximum.reduceat(p, first[:-1][some])
        total[some] = np.add.reduceat(p, first[:-1][some])
    best = np.clip(best, 1e-4, 1 - 1e-4)
    return np.column_stack([np.log(best / (1 - best)), np.log1p(total), np.log1p(1000 * total / np.maximum(n, 1))])


def fit(texts: list[bytes], y: np.ndarray, weight: np.ndarray) -> Model:
    """Two thirds of the documents fit the tagger, all others the step from its marginals to a document's score."""
    if len(set(y.tolist())) < 2:
        constant = np.array([0.0, 0.0, 0.0, 20.0 if len(y) and y[0] == 1 else -20.0])
        return Model(np.zeros(_NOTHING + 1, np.float32), np.zeros(4), constant)
    part = np.arange(len(texts)) % 3 != 0
    own = tokens_of([t for t, k in zip(texts, part, strict=True) if k])
    weights, steps = fit_tokens(own, token_labels(own, y[part] == 1))
    rest = tokens_of([t for t, k in zip(texts, part, strict=True) if not k])
    x = _document_features(marginals(rest, weights, steps), rest.first)
    return Model(weights.astype(np.float32), steps, logistic(x, y[~part], weight[~part]))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, folds: int = FOLDS, held_fold: int = HELD_FOLD) -> Model:
    """The model of the documents that `labels.toxic` marks and that aren't held out."""
    return fit(*labelled_sample(docs, labels, "toxic", fold("doc_id", folds) == held_fold, per_class))


def score_texts(texts: list[bytes], model: Model) -> tuple[np.ndarray, list[list[dict]]]:
    """Scores and toxic spans, as character offsets, of UTF-8 texts."""
    tokens = tokens_of(texts)
    p = marginals(tokens, model.weights, model.steps)
    x = np.column_stack([_document_features(p, tokens.first), np.ones(len(texts))])
    spans: list[list[dict]] = [[] for _ in texts]
    hits = np.flatnonzero(p >= THRESHOLD)
    if len(hits):
        places = np.concatenate([[0], np.cumsum((tokens.data & 0xC0) != 0x80)])
        owner = np.searchsorted(tokens.first, hits, side="right") - 1
        begins = np.cumsum([1] + [len(t) + 1 for t in texts])[owner]
        for k, a, b in zip(owner.tolist(), places[tokens.starts[hits]] - places[begins], places[tokens.ends[hits]] - places[begins], strict=True):
            spans[k].append({"start": int(a), "end": int(b)})
    return sigmoid(x @ model.document), spans


def scored_rows(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of docs and score, predicted, toxic_spans; columns of docs with these names are replaced.

    Null and empty texts score as texts without any toxic token. toxic_spans are character offsets of the tokens that are
    toxic with a probability of one half or more. An empty table gives no rows.
    """
    added = ("score", "predicted", "toxic_spans")
    docs = docs.select(*[c for c in docs.columns if c not in added])
    span = T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType())
    schema = T.StructType([*docs.schema.fields]).add("score", T.DoubleType()).add("predicted", T.IntegerType()).add("toxic_spans", T.ArrayType(span))
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            score, spans = score_texts(texts, model)
            columns = [*rows.columns, pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32)), pa.array(spans, spans_type)]
            yield pa.RecordBatch.from_arrays(columns, [*rows.schema.names, *added])

    return docs.mapInArrow(run, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted, toxic_spans), one for each row of docs.

    docs: columns doc_id, text; labels: doc_id, toxic; others are not read. The tagger learns from labelled tokens of a
    bounded sample of the labelled documents that aren't held out (PER_CLASS of each class); it sees nothing but the text.
    held_out is null for a null doc_id. Without labels of both classes every text gets the same score.
    """
    model = train(docs, labels)
    scored = scored_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), model)
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD_FOLD).alias("held_out"), "score", "predicted", "toxic_spans")
