"""Whitening of embeddings on their leading components, by Chebyshev-filtered subspace iteration.

Vectors become whole numbers, so sums are exact.  The distinct vectors are packed into blocks and
written; every product of the covariance with a narrow matrix is one distributed pass over the
blocks, ``X'(XQ)`` with ``X`` centred in the task.  A polynomial in the covariance, by its three-term
recurrence of such passes, damps what lies below the wanted part of the spectrum; QR and
Rayleigh-Ritz turn the result into components, until their residuals are certified.
"""

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import write_once

COMPONENTS = 4
#: Vectors carried beside the wanted ones; their values show that none was missed.
GUARDS = 16
#: Passes in one polynomial, and polynomials at most.
DEGREE, ROUNDS = 12, 60
#: Residual of a component as a share of the first eigenvalue.
TOLERANCE = 1e-14
#: Bytes of a block of packed vectors.
BLOCK = 1 << 20
SCALE = 256.0
LIMB = 40
#: A component whose eigenvalue is below this share of the trace has no spread to scale by.
NOTHING = 1e-13


def usable(vec: str = "embedding"):
    """Vectors that are there and whose entries all are finite numbers."""
    bad = F.exists(vec, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.col(vec).isNotNull() & ~bad


def whole(column: pa.Array, width: int) -> np.ndarray:
    """floor(256 c) of every entry as 64-bit integers, a row a vector, 0 in dimensions that it lacks."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = np.floor(np.asarray(column.flatten(), np.float64) * SCALE)
    edge = np.nextafter(2.0 ** 63, 0)
    values = np.clip(values, -edge, edge).astype(np.int64)
    sizes = np.diff(np.asarray(column.offsets))
    if (sizes == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _arrow(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def packed(x: np.ndarray) -> list[bytes]:
    """Bytes of each row in the narrowest integers that hold it, one code a vector."""
    size = np.abs(x).max(axis=1, initial=0)
    out = [b""] * len(x)
    for kind, low, high in (("i2", -1, 2 ** 15), ("i4", 2 ** 15, 2 ** 31), ("i8", 2 ** 31, 2 ** 64)):
        at = np.flatnonzero((size >= max(low, 0)) & (size < high))
        for i, row in zip(at, x[at].astype(f"<{kind}")):
            out[i] = row.tobytes()
    return out


def unpacked(codes: list[bytes], width: int) -> np.ndarray:
    out = np.empty((len(codes), width), np.int64)
    sizes = np.fromiter(map(len, codes), np.int64, len(codes))
    for bytes_, kind in ((2, "<i2"), (4, "<i4"), (8, "<i8")):
        at = np.flatnonzero(sizes == bytes_ * width)
        out[at] = np.frombuffer(b"".join(codes[i] for i in at), kind).reshape(len(at), width)
    return out


def fit_blocks(vectors: DataFrame, width: int) -> DataFrame:
    """(block): each distinct vector once, many to a row."""
    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(packed(whole(b.column(0), width)), pa.binary())], ["code"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, BLOCK // (8 * width))
        for b in batches:
            held = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([unpacked(held[a:a + step], width).tobytes() for a in range(0, len(held), step)], pa.binary())], ["block"])

    once = vectors.select("embedding").mapInArrow(codes, "code binary").distinct()
    return write_once(once.mapInArrow(blocks, "block binary"), "blocks")


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for b in batches:
        for block in b.column(0):
            yield np.frombuffer(block.as_buffer(), np.int64).reshape(-1, width)


def exact_sums(blocks: DataFrame, width: int) -> tuple[int, list[int], int]:
    """Rows, sum of each dimension, and sum of all squares, as integers of any size."""
    def limbs(place: int, value: int) -> list[tuple[int, int, int]]:
        sign, value, out = (1, value, []) if value >= 0 else (-1, -value, [])
        k = 0
        while value:
            out.append((place, k, sign * (value & ((1 << LIMB) - 1))))
            value, k = value >> LIMB, k + 1
        return out

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, [0] * width, 0
        for x in _matrices(batches, width):
            n += len(x)
            small = np.abs(x).max(initial=0) < 2 ** 20 and len(x) < 2 ** 20
            own = x if small else x.astype(object)
            sums = [a + int(b) for a, b in zip(sums, own.sum(axis=0))]
            squares += int((own * own).sum(axis=0).astype(object).sum())
        rows = [r for j, v in enumerate([*sums, squares, n]) for r in limbs(j, v)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["place", "limb", "value"])

    found = blocks.mapInArrow(partial, "place long, limb long, value long").groupBy("place", "limb").agg(F.sum("value").alias("value"))
    total = [0] * (width + 2)
    for r in found.collect():  # a few numbers a dimension
        total[r.place] += r.value << (LIMB * r.limb)
    return total[-1], total[:width], total[-2]


def summed(blocks: DataFrame, width: int, shape: tuple[int, int], product) -> np.ndarray:
    """Sum over all tasks of ``product`` of their vectors; of fixed size, added up by Spark."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for x in _matrices(batches, width):
            total += product(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["place", "value"])

    out = np.zeros(shape[0] * shape[1])
    for r in blocks.mapInArrow(partial, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect():
        out[r.place] = r.value
    return out.reshape(shape)


def leading(times, width: int, wanted: int, guards: int = GUARDS, degree: int = DEGREE, tolerance: float = TOLERANCE,
            rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """The first eigenvalues and unit eigenvectors of a covariance known by its products ``times(Q)``.

    Each round applies a Chebyshev polynomial that is at most 1 in size from 0, below which a
    covariance has no value, up to the smallest value of the block, and grows steeply above it.
    Ends when the residuals of the wanted vectors are below ``tolerance`` of the first value, or
    have stopped falling near the precision of the products.  Returns the largest residual as well.
    """
    k = min(width, wanted + guards)
    q = np.linalg.qr(np.random.default_rng(42).standard_normal((width, k)))[0]
    worst, since = np.inf, 0
    best = None
    for _ in range(rounds):
        vq = times(q)
        h = q.T @ vq
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = max(values[0], 0.0)
        residual = float(np.linalg.norm(vq - q * values, axis=0)[:wanted].max(initial=0.0)) / (top or 1.0)
        if residual < worst:
            since = 0 if residual < worst / 2 else since + 1
            worst, best = residual, (values[:wanted].copy(), q[:, :wanted].copy())
        else:
            since += 1
        cut = values[-1]
        if residual <= tolerance or k == width and since >= 2 or since >= 3 and worst < 1e-10 or cut <= top * 1e-15:
            break
        middle = cut / 2
        scale = sigma = middle / (middle - top)  # keeps the values at the first eigenvalue near 1
        before, now = q, (vq - middle * q) * (sigma / middle)
        for _ in range(degree - 1):
            following = 1 / (2 / scale - sigma)
            before, now = now, (times(now) - middle * now) * (2 * following / middle) - sigma * following * before
            sigma = following
        # the vectors of the last round stay in order, so a converged one is changed by rounding alone
        q = np.linalg.qr(now)[0]
    return (*best, worst)


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, deviation_digits) of every usable row and component.

    Rows without a vector, or with an entry that is null or not finite, are dropped.  Entries become
    floor(256 c); beyond 64 bits they stop at the last 64-bit number.  A vector shorter than the
    longest reads 0 in the dimensions that it lacks.  The covariance is that of the distinct vectors,
    with their number ``n`` as divisor.  ``deviation`` is null where it needs more than 64 bits;
    ``deviation_digits`` always has it.  A component without spread (below 1e-13 of the trace) is left out,
    so equal vectors, a single one, or an empty table give no rows.  Copies of a row are all returned.
    """
    rows = embeddings.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("embedding")).where(usable())
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, "
              "deviation_digits string")
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    none = embeddings.sparkSession.createDataFrame([], schema)
    if not width:
        return none
    blocks = fit_blocks(rows, width)
    n, sums, squares = exact_sums(blocks, width)
    mean = np.array([float(Fraction(s, n)) for s in sums])
    trace = float(Fraction(n * squares - sum(s * s for s in sums), n * n))
    if trace <= 0:
        return none

    def times(q: np.ndarray) -> np.ndarray:
        def product(x):
            centred = x - mean
            return centred.T @ (centred @ q)
        return summed(blocks, width, q.shape, product) / n

    values, vectors, _ = leading(times, width, min(components, width))
    keep = values > NOTHING * trace
    values, vectors = values[keep], vectors[:, keep]
    if not len(values):
        return none
    scaled = vectors / np.sqrt(values)

    def spread(x):
        w = (x - mean) @ scaled
        return w.T @ w

    error = float(np.abs(summed(blocks, width, (len(values), len(values)), spread) / n - np.eye(len(values))).max())
    large = max(map(abs, sums))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = len(values)
        total = sum(s * s for s in sums)
        for b in batches:
            x = whole(_arrow(b, "embedding"), width)
            exact = x if width * int(np.abs(x).max(initial=0)) * max(large, int(np.abs(x).max(initial=0))) < 2 ** 62 else x.astype(object)
            own, with_sums = (exact * exact).sum(axis=1), exact @ np.array(sums, object if exact.dtype == object or large >= 2 ** 62 else np.int64)
            deviation = [n * n * int(a) - 2 * n * int(c) + total for a, c in zip(own, with_sums)]
            deviation = [v for v in deviation for _ in range(m)]
            ids = _arrow(b, "vec_id").take(pa.array(np.repeat(np.arange(len(x)), m)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * m, n)),
                 pa.array([v if v < 2 ** 63 else None for v in deviation], pa.int64()), pa.array(((x - mean) @ scaled).ravel()),
                 pa.array(np.tile(values / trace, len(x))), pa.array(np.full(len(x) * m, error)), pa.array(map(str, deviation), pa.string())],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_digits"])

    return rows.mapInArrow(finish, schema)
