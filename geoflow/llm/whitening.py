"""Whitening of vectors by the leading components of their covariance, found by Jacobi-Davidson iteration."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hard_negatives import SCALE, whole_components
from .scratch import Scratch

COMPONENTS = 4
#: Vectors of one block, and parts that partial sums are added up in before they come to the driver.
BLOCK_ROWS, PARTS = 4096, 8
#: For each component: vectors of the first search space, pairs that are corrected at once, and vectors at which the space is begun anew.
#: Products of many vectors take a job as products of one do.
FIRST, CORRECTED, SPACE = 4, 2, 12
#: Products of one correction, at most, and steps of the whole iteration.
INNER, OUTER = 4, 60
#: A component with less than this share of the trace has no direction that could be told from rounding.
NO_VARIANCE = 1e-12
_MOST = (1 << 63) - 1


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as the bytes of their numbers, so that each product reads them without decoding."""
    for batch in batches:
        for at in range(0, len(batch), BLOCK_ROWS):
            some = batch.slice(at, BLOCK_ROWS)
            numbers = some.column("x").flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array([len(some)], pa.int64()), pa.array([numbers.tobytes()], pa.binary())], ["n", "data"])


def _rows_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for n, data in zip(batch.column("n").to_pylist(), batch.column("data"), strict=True):
        yield np.frombuffer(data.as_buffer(), np.int64).reshape(n, -1)


def _largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def _column_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact sums of each dimension over a partition, as text, as they may be longer than 64 bits."""
    total: np.ndarray | int = 0
    for batch in batches:
        for x in _rows_of(batch):
            total = total + (x.sum(axis=0) if _largest(x) < 1 << 40 else x.astype(object).sum(axis=0)).astype(object)
    if not isinstance(total, int):
        yield pa.RecordBatch.from_arrays([pa.array([[str(v) for v in total]])], ["sums"])


def _texts_added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: list[int] = []
    for batch in batches:
        for sums in batch.column("sums").to_pylist():
            total = [a + int(b) for a, b in zip(total or [0] * len(sums), sums, strict=True)]
    if total:
        yield pa.RecordBatch.from_arrays([pa.array([[str(v) for v in total]])], ["sums"])


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, which is n times the distance to the mean, in whole numbers."""
    if n * _largest(x) + max(map(abs, sums), default=0) < 1 << 62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _distances(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return centred(x, n, sums).astype(np.float64) / n


class Covariance:
    """The covariance of a list of vectors, known by its products with other vectors only; each product is one job."""

    def __init__(self, blocks: DataFrame):
        self.blocks = blocks
        self.n = int(blocks.agg(F.sum("n")).first()[0] or 0)
        parts = blocks.mapInArrow(_column_sums, "sums array<string>").repartition(PARTS).mapInArrow(_texts_added, "sums array<string>").collect()
        self.sums = [sum(int(p.sums[i]) for p in parts) for i in range(len(parts[0].sums))] if parts else []
        self.dims = len(self.sums)
        self.products = 0

    def _total(self, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        """The sum of a function of the distances to the mean over all vectors: by partition, by part, on the driver."""
        n, sums = self.n, self.sums

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                for x in _rows_of(batch):
                    total += of(_distances(x, n, sums))
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["p"])

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                for p in batch.column("p"):
                    total += np.frombuffer(p.as_buffer()).reshape(shape)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["p"])

        rows = self.blocks.mapInArrow(partial, "p binary").repartition(PARTS).mapInArrow(added, "p binary").collect()
        return sum((np.frombuffer(bytes(r.p)).reshape(shape) for r in sorted(rows, key=lambda r: bytes(r.p))), np.zeros(shape))

    def times(self, vectors: np.ndarray) -> np.ndarray:
        """The product with the columns of vectors, whose number is small."""
        self.products += 1
        return self._total(lambda c: c.T @ (c @ vectors), vectors.shape) / self.n

    def trace(self) -> float:
        return float(self._total(lambda c: np.array([np.sum(c * c)]), (1,))[0]) / self.n

    def of_projections(self, vectors: np.ndarray) -> np.ndarray:
        """The covariance of the vectors' projections on the columns."""
        k = vectors.shape[1]
        total = self._total(lambda c: np.vstack([(y := c @ vectors).T @ y, y.sum(axis=0)]), (k + 1, k)) / self.n
        return total[:k] - np.outer(total[k], total[k])


def _orthonormal(vectors: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Unit columns that span what is new in the columns of vectors; those with nothing new are left out."""
    out = against
    for v in vectors.T:
        size = np.linalg.norm(v)
        if not size > 0:
            continue
        v = v / size
        for _ in range(3):
            v = v - out @ (out.T @ v)
            left = np.linalg.norm(v)
            if left < 1e-10:
                break
            v = v / left
        else:
            out = np.column_stack([out, v])
    return out[:, against.shape[1] :]


def minres(times: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Approximate solutions of several symmetric systems, one for each column, all by the same number of products."""
    x = np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    start = np.where(beta > 0, beta, 1.0)
    v_old, v = np.zeros_like(right), right / start
    w_old, w = np.zeros_like(right), np.zeros_like(right)
    c, c_old, s, s_old = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    eta, before = beta.copy(), np.zeros_like(beta)
    for _ in range(steps):
        p = times(v)
        alpha = np.sum(v * p, axis=0)
        p = p - alpha * v - before * v_old
        after = np.linalg.norm(p, axis=0)
        # the new column of the triangular factor, by the two last rotations and the next one
        delta = c * alpha - c_old * s * before
        upper2, upper1 = s_old * before, s * alpha + c_old * c * before
        upper0 = np.hypot(delta, after)
        live = (upper0 > 1e-14 * start) & (np.abs(eta) > 0)
        safe = np.where(upper0 > 0, upper0, 1.0)
        c_old, c, s_old, s = c, delta / safe, s, after / safe
        w_old, w = w, (v - upper1 * w - upper2 * w_old) / safe
        x = x + np.where(live, c * eta, 0.0) * w
        eta = np.where(live, -s * eta, 0.0)
        v_old, v, before = v, p / np.where(after > 0, after, 1.0), after
        if np.all(np.abs(eta) <= tolerance * beta):
            break
    return x


def leading_components(times: Callable[[np.ndarray], np.ndarray], dims: int, count: int, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric positive matrix, falling, and their unit eigenvectors as columns.

    The matrix is known by its products only. A search space gives Ritz pairs; each pair that isn't good enough asks for a
    correction orthogonal to itself and to the pairs that are done, which MINRES solves for all pairs at once, and the space
    grows by the corrections. Pairs are locked in their order once their residuals are as small as rounding lets them become.
    """
    count = min(count, dims)
    rng = np.random.Generator(np.random.PCG64(seed))
    locked, values = np.empty((dims, 0)), []
    space = _orthonormal(rng.standard_normal((dims, min(dims, FIRST * count))), locked)
    image = times(space)
    least, waited = np.full(count, np.inf), 0
    for step in range(OUTER):
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        top = max([*values, theta[0], 0.0])
        enough = dims * np.finfo(float).eps * top
        missing = count - len(values)
        size = np.linalg.norm(image[:, :missing] - space[:, :missing] * theta[:missing], axis=0)
        # rounding of the products may keep a residual above the goal; it is then as small as it gets
        waited = 0 if np.any(size[:1] < 0.5 * least[:1]) else waited + 1
        least = np.minimum(least[: len(size)], size)
        stuck = waited >= 3 and size[0] <= 1000 * enough
        done = 0
        while done < missing and (size[done] <= enough or (stuck and size[done] <= 1000 * enough)):
            done += 1
        if done:
            locked = np.column_stack([locked, space[:, :done]])
            values += theta[:done].tolist()
            space, image = space[:, done:], image[:, done:]
            theta, size = theta[done:], size[done:]
            least, waited = np.full(count, np.inf), 0
        missing = count - len(values)
        if not missing or space.shape[1] == 0 and locked.shape[1] == dims:
            break
        if space.shape[1] >= SPACE * count:
            space = _orthonormal(space[:, : FIRST * count], locked)
            image = times(space)
        if space.shape[1] < missing:
            new = _orthonormal(rng.standard_normal((dims, missing)), np.column_stack([locked, space]))
        else:
            many = min(CORRECTED * count, space.shape[1])
            ritz, shift = space[:, :many], theta[:many]
            residual = image[:, :many] - ritz * shift

            def projected(p: np.ndarray, ritz: np.ndarray = ritz) -> np.ndarray:
                p = p - locked @ (locked.T @ p)
                return p - ritz * np.sum(ritz * p, axis=0)

            def shifted(p: np.ndarray, shift: np.ndarray = shift) -> np.ndarray:
                p = projected(p)
                return projected(times(p) - p * shift)

            fix = minres(shifted, projected(-residual), min(INNER, dims), 2.0 ** -(step + 2))
            new = _orthonormal(fix, np.column_stack([locked, space]))
            if new.shape[1] == 0:
                new = _orthonormal(rng.standard_normal((dims, missing)), np.column_stack([locked, space]))
        if new.shape[1] == 0:  # the space has all dimensions; what is left of the residuals is rounding
            new = _orthonormal(space, locked)
            space, image = new, times(new)
            waited += 1
            continue
        space, image = np.column_stack([space, new]), np.column_stack([image, times(new)])
    else:
        raise ArithmeticError(f"{len(values)} of {count} components after {OUTER} steps")
    order = np.argsort(values, kind="stable")[::-1]
    return np.array(values)[order], locked[:, order]


def _projected(n: int, sums: list[int], axes: np.ndarray, scale: np.ndarray, explained: np.ndarray, error: float):
    k = axes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK_ROWS):
                some = batch.slice(at, BLOCK_ROWS)
                x = some.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(some), -1)
                far = centred(x, n, sums)
                small = far.dtype == np.int64 and _largest(far) ** 2 * max(1, far.shape[1]) <= _MOST
                squares = (far * far).sum(axis=1).tolist() if small else [sum(int(v) ** 2 for v in row) for row in far]
                deviation = pa.array([v if v <= _MOST else None for v in squares], pa.int64())
                whitened = (far.astype(np.float64) / n) @ axes / scale
                each = np.repeat(np.arange(len(some)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(some))),
                        pa.array(np.full(len(each), n)), deviation.take(pa.array(each)), pa.array(whitened.reshape(-1)),
                        pa.array(np.tile(explained, len(some))), pa.array(np.full(len(each), error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whitened_vectors(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error): `components` for each row of vectors.

    Components become whole numbers, floor(256 * c). Mean and covariance are those of the different vectors, each counted
    once; n is their number. `whitened` is the projection on a component over the root of its eigenvalue, `explained` the
    eigenvalue's share of the trace, `deviation` the exact squared length of n times the distance to the mean (null beyond 64
    bits), `identity_error` the largest entry by which the covariance of `whitened` differs from the identity.

    vectors: columns vec_id, embedding; others are not read. Rows whose vector is null or has a component that is null, not
    finite or beyond 64 bits give nothing; a null vec_id is an id like others. Repeated rows and rows with equal vectors have equal results. There
    are no more components than dimensions, and none without variance: a single vector, empty vectors and an empty table give no rows.
    Vectors of different lengths raise an error. The sign of a component is such that its largest entry is positive.

    The covariance is never built: every product with it is a job over the different vectors, whose partial sums (as many
    numbers as dimensions times components) are added up in a few tasks before they come to the driver.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "whitening")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole_components("embedding", scale).alias("x")).where("size(x) > 0")
    blocks = scratch.keep(rows.select("x").distinct().mapInArrow(_blocks, "n bigint, data binary"))
    nothing = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    sizes = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if sizes[0] != sizes[1]:
        raise ValueError(f"vectors of {sizes[0]} to {sizes[1]} components can't be whitened together")
    covariance = Covariance(blocks)
    if covariance.n < 2:
        return spark.createDataFrame([], nothing)
    trace = covariance.trace()
    values, axes = leading_components(covariance.times, covariance.dims, components)
    some = values > NO_VARIANCE * trace
    values, axes = values[some], axes[:, some]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    roots = np.sqrt(values)
    error = float(np.abs(covariance.of_projections(axes / roots) - np.eye(len(values))).max())
    return rows.mapInArrow(_projected(covariance.n, covariance.sums, axes, roots, values / trace, error), nothing)
