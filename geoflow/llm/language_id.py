"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import class_sample, fold
from .wordbytes import LOWER, slices

#: Documents of each language that the network is trained on, at most.
PER_CLASS = 300
FOLDS, HELD_FOLD = 3, 1
UNKNOWN = "und"
HIDDEN = 8
#: Texts are read in runs of so many bytes, A-Z as a-z; both directions begin anew in each.
RUN = 128
_TRAIN_RUN, _BATCH, _STEPS = 48, 192, 220
_LANES = 4096


@dataclass
class Cell:
    """One direction: input weights of each byte (with the constants), recurrent weights; gates update, reset, new state."""

    inputs: np.ndarray
    recurrent: np.ndarray


@dataclass
class Model:
    languages: list
    ahead: Cell
    back: Cell
    #: From both states to the languages, constants last.
    out: np.ndarray


def _step(cell: Cell, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of h (HIDDEN, lanes); gates and state are piecewise linear, between 0 and 1 and between -1 and 1."""
    k = len(h)
    gx, gh = cell.inputs[x].T, cell.recurrent @ h
    gates = np.clip(gx[: 2 * k] + gh[: 2 * k], 0, 1)
    raw = gx[2 * k :] + gates[k:] * gh[2 * k :]
    new = np.clip(raw, -1, 1)
    return new + gates[:k] * (h - new), gates, raw, new, gh[2 * k :]


def _forward(cell: Cell, x: np.ndarray) -> tuple[np.ndarray, list]:
    h = np.zeros((cell.recurrent.shape[1], x.shape[1]))
    states, kept = [], []
    for row in x:
        before = h
        h, *rest = _step(cell, row, h)
        states.append(h)
        kept.append((before, *rest))
    return np.stack(states), kept


def _through_time(cell: Cell, x: np.ndarray, kept: list, d_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input and recurrent weights, from the last step back to the first."""
    k = cell.recurrent.shape[1]
    d_recurrent, d_inputs = np.zeros_like(cell.recurrent), []
    d_h = np.zeros_like(d_states[0])
    for t in range(len(x) - 1, -1, -1):
        before, gates, raw, new, gn = kept[t]
        d_h = d_h + d_states[t]
        update, reset = gates[:k], gates[k:]
        d_raw = d_h * (1 - update) * (np.abs(raw) < 1)
        open_gate = (gates > 0) & (gates < 1)
        d_update = d_h * (before - new) * open_gate[:k]
        d_reset = d_raw * gn * open_gate[k:]
        d_gh = np.concatenate([d_update, d_reset, d_raw * reset])
        d_recurrent += d_gh @ before.T
        d_inputs.append(np.concatenate([d_update, d_reset, d_raw]))
        d_h = d_h * update + cell.recurrent.T @ d_gh
    flat = np.stack(d_inputs[::-1]).transpose(1, 0, 2).reshape(3 * k, -1)
    return np.stack([np.bincount(x.ravel(), row, 256) for row in flat], axis=1), d_recurrent


def fit(texts: list[bytes], languages: list, hidden: int = HIDDEN, steps: int = _STEPS, seed: int = 11) -> Model:
    """Trained on runs of the texts, as many of each language in every step; every position is to name the language."""
    names = sorted(set(languages))
    rng = np.random.Generator(np.random.PCG64(seed))

    def cell() -> Cell:
        inputs = rng.normal(0, 0.3, (256, 3 * hidden))
        inputs[:, :hidden] += 0.6
        inputs[:, hidden : 2 * hidden] += 0.5
        return Cell(inputs, rng.normal(0, 0.3 / np.sqrt(hidden), (3 * hidden, hidden)))

    ahead, back = cell(), cell()
    out = np.concatenate([rng.normal(0, 0.3, (len(names), 2 * hidden)), np.zeros((len(names), 1))], axis=1)
    pools = []
    for name in names:
        joined = b"\n".join(t for t, x in zip(texts, languages, strict=True) if x == name)
        pools.append(LOWER[np.frombuffer(joined + b"\n" * (_TRAIN_RUN + 1), np.uint8)])
    if not names:
        return Model([], ahead, back, out)
    params = [ahead.inputs, ahead.recurrent, back.inputs, back.recurrent, out]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    per = max(4, _BATCH // len(names))
    y = np.repeat(np.arange(len(names)), per)
    truth = np.eye(len(names))[y].T
    for step in range(1, steps + 1):
        x = np.stack([p[s : s + _TRAIN_RUN] for p in pools for s in rng.integers(0, len(p) - _TRAIN_RUN, per)], axis=1).astype(np.int64)
        h1, kept1 = _forward(ahead, x)
        h2, kept2 = _forward(back, x[::-1])
        both = np.concatenate([h1, h2[::-1], np.ones((len(x), 1, x.shape[1]))], axis=1)
        logits = np.einsum("lk,tkb->tlb", out, both)
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        d_logits = (p - truth) / (p.shape[0] * p.shape[2])
        d_out = np.einsum("tlb,tkb->lk", d_logits, both)
        d_both = np.einsum("lk,tlb->tkb", out, d_logits)
        g1 = _through_time(ahead, x, kept1, d_both[:, :hidden])
        g2 = _through_time(back, x[::-1], kept2, d_both[::-1, hidden : 2 * hidden])
        rate = 0.03 * min(1.0, 2 * (1 - step / (steps + 1)))
        for p_, m, v, g in zip(params, first, second, [*g1, *g2, d_out], strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p_ -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(names, ahead, back, out)


class _Reader:
    """Runs a cell over many lanes with no new arrays in a step."""

    def __init__(self, cell: Cell, lanes: int):
        self.k = cell.recurrent.shape[1]
        self.inputs, self.recurrent = cell.inputs.astype(np.float32), cell.recurrent.astype(np.float32)
        self.rows = np.empty((lanes, 3 * self.k), np.float32)
        self.gx, self.gh = np.empty((3 * self.k, lanes), np.float32), np.empty((3 * self.k, lanes), np.float32)
        self.gates, self.new = np.empty((2 * self.k, lanes), np.float32), np.empty((self.k, lanes), np.float32)

    def step(self, x: np.ndarray, h: np.ndarray, out: np.ndarray) -> None:
        k = self.k
        self.inputs.take(x, axis=0, out=self.rows, mode="clip")
        np.copyto(self.gx, self.rows.T)
        np.matmul(self.recurrent, h, out=self.gh)
        gates, new = self.gates, self.new
        np.add(self.gx[: 2 * k], self.gh[: 2 * k], out=gates)
        np.maximum(gates, 0, out=gates)
        np.minimum(gates, 1, out=gates)
        np.multiply(gates[k:], self.gh[2 * k :], out=new)
        new += self.gx[2 * k :]
        np.maximum(new, -1, out=new)
        np.minimum(new, 1, out=new)
        np.subtract(h, new, out=out)
        out *= gates[:k]
        out += new


def pooled(texts: list[bytes], model: Model) -> np.ndarray:
    """Mean over all positions of the probability of each language, (texts, languages); 0 for empty texts."""
    n_langs, k = len(model.languages), model.ahead.recurrent.shape[1]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    data = LOWER[np.frombuffer(b"".join(texts) + b"\n" * RUN, np.uint8)]
    offsets = np.cumsum(lengths) - lengths
    runs = -(-lengths // RUN)
    doc = np.repeat(np.arange(len(texts)), runs)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs)
    begins = offsets[doc] + nth * RUN
    sizes = np.minimum(lengths[doc] - nth * RUN, RUN)
    total = np.zeros((len(texts), n_langs))
    out = model.out.astype(np.float32)
    for lo in range(0, len(begins), _LANES):
        at, size = begins[lo : lo + _LANES], sizes[lo : lo + _LANES]
        n, longest = len(at), int(size.max())
        x = data[at[None, :] + np.arange(longest)[:, None]].astype(np.int64)
        inside = np.arange(longest)[:, None] < size[None, :]
        states = np.zeros((longest + 1, k, n), np.float32)
        ahead, back = _Reader(model.ahead, n), _Reader(model.back, n)
        for t in range(longest):
            ahead.step(x[t], states[t], states[t + 1])
        h, nxt = np.zeros((k, n), np.float32), np.empty((k, n), np.float32)
        sums = np.zeros((n_langs, n))
        logits, part = np.empty((n_langs, n), np.float32), np.empty((n_langs, n), np.float32)
        for t in range(longest - 1, -1, -1):
            back.step(x[t], h, nxt)
            # a lane that ends before this place has no state yet
            nxt *= inside[t]
            h, nxt = nxt, h
            np.matmul(out[:, :k], states[t + 1], out=logits)
            np.matmul(out[:, k : 2 * k], h, out=part)
            logits += part
            logits += out[:, -1:]
            np.exp(logits, out=logits)
            np.divide(inside[t], logits.sum(axis=0), out=part[0])
            logits *= part[0]
            sums += logits
        for name in range(n_langs):
            total[:, name] += np.bincount(doc[lo : lo + n], sums[name], len(texts))
    return total / np.maximum(lengths, 1)[:, None]


def train(docs: DataFrame, per_class: int = PER_CLASS, folds: int = FOLDS, held_fold: int = HELD_FOLD) -> Model:
    """The network of the documents whose lang isn't null and that aren't held out."""
    return fit(*class_sample(docs, "lang", fold("doc_id", folds) == held_fold, per_class))


def predicted_languages(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), one for each row of docs.

    docs: columns doc_id, text, and lang for training; others are not read. The network is trained on a bounded sample of the
    documents that aren't held out (PER_CLASS of each language). It labels every byte of a text; their probabilities are
    averaged, and score is the highest average. Texts that are null or have no letter are `und` with score 0, and so are all
    if no language was learned. held_out is null for a null doc_id. An empty table gives no rows.
    """
    if model is None:
        model = train(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            letters = rows.column("letters").to_numpy(zero_copy_only=False)
            if model.languages:
                p = pooled([t if k else b"" for t, k in zip(texts, letters, strict=True)], model)
                best, score = p.argmax(axis=1), np.clip(p.max(axis=1), 0, 1)
                names = [model.languages[i] if k else UNKNOWN for i, k in zip(best.tolist(), letters, strict=True)]
            else:
                names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    marked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    named = marked.mapInArrow(run, "doc_id bigint, lang_pred string, score double")
    return named.select("doc_id", (fold("doc_id", FOLDS) == HELD_FOLD).alias("held_out"), "lang_pred", "score")
