"""Words of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
#: The bytes that separate words.
SPACES = b" \t\n\x0b\x0c\r"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_TABLE_ROWS = 64
_TABLE = np.random.Generator(np.random.PCG64(20240601)).integers(0, 2**64, (_TABLE_ROWS, 256), np.uint64)


@dataclass
class Words:
    """data: the bytes of all texts, each between line breaks. Word i is data[starts[i]:ends[i]]; text k has words first[k]:first[k + 1]."""

    data: np.ndarray
    inside: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows with about `most` bytes of text; a longer text is a run of its own. Null texts are empty."""
    for batch in batches:
        texts = [x or b"" for x in batch.column(text).cast(pa.binary()).to_pylist()]
        begin = size = 0
        for i, x in enumerate(texts):
            if size and size + len(x) > most:
                yield batch.slice(begin, i - begin), texts[begin:i]
                begin, size = i, 0
            size += len(x)
        if begin < len(texts):
            yield batch.slice(begin), texts[begin:]


def split_words(texts: list[bytes], lower: bool = False, separators: np.ndarray = _IS_SPACE) -> Words:
    data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        data = LOWER[data]
    inside = ~separators[data]
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = turns[::2], turns[1::2]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate([[1], 1 + np.cumsum(lengths + 1)])
    return Words(data, inside, starts, ends, np.searchsorted(starts, begins))


def mixed(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def segment_hash(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of consecutive runs of bytes, by tabulation; every run has at least one byte."""
    if not len(lengths):
        return np.empty(0, np.uint64)
    offsets = np.cumsum(lengths) - lengths
    place = np.arange(len(symbols), dtype=np.int32) - np.repeat(offsets.astype(np.int32), lengths)
    values = _TABLE.ravel().take(((place & (_TABLE_ROWS - 1)) << 8) | symbols)
    if int(lengths.max()) > _TABLE_ROWS:
        values *= (2 * (place >> 6) + 1).astype(np.uint64)
    return mixed(np.add.reduceat(values, offsets) + lengths.astype(np.uint64))


def word_hashes(words: Words) -> np.ndarray:
    return segment_hash(words.data[words.inside], words.ends - words.starts)


def sorted_order(keys: np.ndarray) -> np.ndarray:
    """The stable order of 64-bit keys: the place goes into the low bits, which makes it a plain sort of integers."""
    bits = np.uint64(max(1, int(len(keys)).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    packed = np.sort((keys & ~low) | np.arange(len(keys), dtype=np.uint64))
    order = (packed & low).astype(np.int64)
    got = keys[order]
    if np.any(got[1:] < got[:-1]):  # different keys that agree in all but the low bits
        order = np.argsort(keys, kind="stable")
    return order


# The primes of XXH64.
_P1, _P2, _P3 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_P4, _P5 = np.uint64(0x85EBCA77C2B2AE63), np.uint64(0x27D4EB2F165667C5)
LONG_SLICE = 512


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _lane(acc: np.ndarray | np.uint64, word: np.ndarray) -> np.ndarray:
    return _turned(acc + word * _P2, 31) * _P1


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of data[starts[i]:ends[i]] for all i, one length after the other."""
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words8 = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    words4 = np.ndarray((len(data) + 1,), "<u4", padded, strides=(1,))
    lengths = ends - starts
    key = np.minimum(lengths, LONG_SLICE + 1).astype(np.uint16)
    order = np.argsort(key, kind="stable")
    kinds, begins = np.unique(key[order], return_index=True)
    seed64 = np.full(1, seed, np.uint64)
    for length, lo, hi in zip(kinds.tolist(), begins, [*begins[1:], len(order)], strict=True):
        rows = order[lo:hi]
        at = starts[rows]
        if length > LONG_SLICE:
            import xxhash

            whole = data.tobytes()
            out[rows] = [xxhash.xxh64_intdigest(whole[a:b], seed) for a, b in zip(at.tolist(), ends[rows].tolist(), strict=True)]
            continue
        done = 0
        if length >= 32:
            lanes = [seed64 + _P1 + _P2, seed64 + _P2, seed64, seed64 - _P1]
            while length - done >= 32:
                lanes = [_lane(v, words8[at + (done + 8 * i)]) for i, v in enumerate(lanes)]
                done += 32
            acc = _turned(lanes[0], 1) + _turned(lanes[1], 7) + _turned(lanes[2], 12) + _turned(lanes[3], 18)
            for v in lanes:
                acc = (acc ^ _lane(np.uint64(0), v)) * _P1 + _P4
            acc = acc + np.uint64(length)
        else:
            acc = np.full(len(rows), seed64[0] + _P5 + np.uint64(length), np.uint64)
        while length - done >= 8:
            acc = _turned(acc ^ _lane(np.uint64(0), words8[at + done]), 27) * _P1 + _P4
            done += 8
        if length - done >= 4:
            acc = _turned(acc ^ (words4[at + done].astype(np.uint64) * _P1), 23) * _P2 + _P3
            done += 4
        while done < length:
            acc = _turned(acc ^ (data[at + done].astype(np.uint64) * _P5), 11) * _P1
            done += 1
        acc = (acc ^ (acc >> np.uint64(33))) * _P2
        acc = (acc ^ (acc >> np.uint64(29))) * _P3
        out[rows] = acc ^ (acc >> np.uint64(32))
    return out
