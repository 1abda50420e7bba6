"""Embedding whitening: leading covariance eigenvectors by Jacobi-Davidson, every product one distributed pass over the rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from palate.llm.common import fields_and, map_batches, release_model, text_buffers, written

SCALE, SHIFT = 1024, 100_000
# Entries of magnitude up to this keep every sum of a batch inside 64 bits.
LARGEST = 2.0 ** 42
# Bytes of a packed block; tasks read up to a thousand at a time.
BLOCK_BYTES = 1 << 15
# Steps of the inner solver per outer step; start vectors beyond the components asked for; basis vectors beyond which only
# the best Ritz vectors are kept.
INNER, EXTRA, MOST = 6, 4, 96
# A residual of so many units of rounding, of the largest eigenvalue, is as small as the products can tell.
UNITS = 16


def integers(column: pa.ListArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of an Arrow list column that take part, and their integer vectors."""
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null entries become NaN
    offsets = column.offsets.to_numpy().astype(np.int64)
    rows = np.flatnonzero((np.diff(offsets) == width) & ~np.asarray(column.is_null()))
    block = values[offsets[rows][:, None] + np.arange(width)]
    taking = (np.abs(block) <= LARGEST).all(axis=1)  # false for NaN
    return rows[taking], np.floor(SCALE * block[taking]).astype(np.int64) + SHIFT


class Fit:
    """The fit list as packed blocks of integers in the shared folder, and the sums that centre it."""

    def __init__(self, blocks: DataFrame, width: int, count: int, sums: list[int]):
        self.blocks, self.width, self.count, self.sums = blocks, width, count, sums

    def centred(self, block: np.ndarray) -> np.ndarray:
        return differences(block, self.count, self.sums).astype(np.float64) / self.count

    def summed(self, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of work(centred block) over all blocks: tasks send one matrix each, added in a fixed order."""
        width, count, sums = self.width, self.count, self.sums

        def run(batches):
            release_model()
            total, first = None, None
            for batch in batches:
                if not batch.num_rows:
                    continue
                packed, bounds = text_buffers(batch.column(1))
                block = packed[:bounds[-1]].view(np.int64).reshape(-1, width)
                part = work(differences(block, count, sums).astype(np.float64) / count).astype(np.longdouble)
                total, first = (part, batch.column(0)[0].as_py()) if total is None else (total + part, first)
            if total is not None:
                high = total.astype(np.float64)
                low = (total - high).astype(np.float64)  # what rounding to doubles would lose
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first], pa.int64()), pa.array([np.stack([high, low]).tobytes()], pa.binary())], names=["first", "part"])

        parts = sorted(self.blocks.mapInArrow(run, "first long, part binary").collect(), key=lambda r: r["first"])
        shape = work(np.zeros((1, width))).shape
        matrices = [np.frombuffer(r["part"]).reshape(2, *shape).astype(np.longdouble) for r in parts]
        return np.sum([m[0] + m[1] for m in matrices], axis=0)

    def covariance_times(self, vectors: np.ndarray) -> np.ndarray:
        return (self.summed(lambda block: block.T @ (block @ vectors)) / self.count).astype(np.float64)


def differences(block: np.ndarray, count: int, sums: list[int]) -> np.ndarray:
    """count * x - sums, exact: 64-bit integers where they suffice, else Python's."""
    if max(np.abs(block).max(initial=0), 1) * count < 1 << 62 and max(map(abs, sums), default=0) < 1 << 62:
        return block * count - np.array(sums, np.int64)
    return block.astype(object) * count - np.array(sums, object)


def fit_list(rows: DataFrame) -> Fit | None:
    """Blocks, count and sums of all vectors (column _vector) that take part; None if there are none.

    The width is that of most vectors (the smaller of equally frequent ones); blocks hold BLOCK_BYTES or one vector.
    """
    usable = F.col("_vector").isNotNull() & (F.size("_vector") > 0)
    widths = rows.where(usable).groupBy(F.size("_vector").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "width").first()
    if widths is None:
        return None
    width = widths["width"]

    def pack(batches):
        release_model()
        for batch in batches:
            _, block = integers(batch.column(0), width)
            size = max(1, BLOCK_BYTES // (8 * width))
            for part in (block[first:first + size] for first in range(0, len(block), size)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.tobytes()], pa.binary()), pa.array([part.sum(axis=0).tolist()], pa.list_(pa.int64())), pa.array([len(part)], pa.int64())],
                    names=["block", "sums", "n"])

    packed = written(map_batches(rows.select("_vector"), pack, "block binary, sums array<long>, n long"), "blocks")
    entries = packed.select("n", F.posexplode("sums").alias("place", "part"))
    sums = entries.groupBy("place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("place").collect()
    if not sums:
        return None
    blocks = packed.select(F.monotonically_increasing_id().alias("number"), "block")
    return Fit(blocks, width, sums[0]["n"], [int(r["s"]) for r in sums])


def minres(product: Callable[[np.ndarray], np.ndarray], shifts: np.ndarray, sides: np.ndarray, project, steps: int) -> np.ndarray:
    """Approximate solutions t of P (A - shift) P t = side, one per column, side by side: one product a step.

    Paige and Saunders' method for symmetric systems that need not be definite. A column whose Krylov space is exhausted stops.
    """
    solution = np.zeros_like(sides)
    old, new = np.zeros_like(sides), sides.copy()
    beta = np.linalg.norm(new, axis=0)
    start = np.where(beta > 0, beta, 1)
    new = new / start
    live = beta > 0
    rest = beta.copy()  # the right-hand side that is left after the rotations
    beta_old = np.zeros_like(beta)
    cosine, sine = np.full((2, len(beta)), 1.0), np.zeros((2, len(beta)))  # the last two rotations, latest first
    directions = [np.zeros_like(sides), np.zeros_like(sides)]
    for _ in range(steps):
        if not live.any():
            break
        image = project(product(new) - new * shifts)
        alpha = np.einsum("ij,ij->j", new, image)
        image = image - new * alpha - old * beta_old
        beta = np.linalg.norm(image, axis=0)
        # rotations of the tridiagonal column (beta_old, alpha, beta)
        epsilon = sine[1] * beta_old
        delta = cosine[1] * beta_old
        upper = cosine[0] * delta + sine[0] * alpha
        diagonal = -sine[0] * delta + cosine[0] * alpha
        radius = np.hypot(diagonal, beta)
        live = live & (radius > 1e-300)
        safe = np.where(radius > 0, radius, 1)
        turn = diagonal / safe, beta / safe
        direction = (new - directions[0] * upper - directions[1] * epsilon) / safe
        solution = solution + np.where(live, turn[0] * rest, 0) * direction
        rest = -turn[1] * rest
        directions = [direction, directions[0]]
        cosine, sine = np.stack([turn[0], cosine[0]]), np.stack([turn[1], sine[0]])
        live = live & (beta > 1e-14 * (np.abs(alpha) + beta_old + beta))
        old, new, beta_old = new, image / np.where(beta > 0, beta, 1), beta
    return project(solution)


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], width: int, wanted: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix given by products.

    Ritz pairs of a growing subspace; for the leading ones a correction is sought in the complement of the locked
    and the current vectors. A pair is locked, largest first, once its residual is as small as rounding allows. A subspace
    that fills the whole space is exact, so the loop ends.
    """
    wanted = min(wanted, width)
    rng = np.random.default_rng(seed)
    basis, _ = np.linalg.qr(rng.standard_normal((width, min(width, wanted + EXTRA))))
    images = product(basis)
    locked, values = np.zeros((width, 0)), []
    largest, polished = 0.0, 0
    while True:
        theta, turns = np.linalg.eigh((basis.T @ images + images.T @ basis) / 2)
        turns = turns[:, ::-1]
        theta, basis, images = theta[::-1], basis @ turns, images @ turns
        largest = max(largest, float(abs(theta).max()), *values)
        residuals = images - basis * theta
        residuals -= locked @ (locked.T @ residuals)
        sizes = np.linalg.norm(residuals, axis=0)
        full = locked.shape[1] + basis.shape[1] == width
        enough = UNITS * np.finfo(float).eps * largest * np.sqrt(width)
        done = 0
        # in a full space the residual is the rounding of the products; one more product of the turned basis renews it
        while done < min(len(theta), wanted - len(values)) and (sizes[done] <= enough or full and polished):
            done += 1
        if done:
            locked = np.hstack([locked, basis[:, :done]])
            values += theta[:done].tolist()
            basis, images, residuals, theta = basis[:, done:], images[:, done:], residuals[:, done:], theta[done:]
        if len(values) == wanted:
            return np.array(values), locked
        if full:
            basis, _ = np.linalg.qr(basis - locked @ (locked.T @ basis))
            images, polished = product(basis), polished + 1
            continue
        if basis.shape[1] > MOST:
            keep = wanted - len(values) + EXTRA
            basis, _ = np.linalg.qr(basis[:, :keep] - locked @ (locked.T @ basis[:, :keep]))
            images = product(basis)
            continue
        active = min(wanted - len(values), basis.shape[1])
        fixed = np.hstack([locked, basis[:, :active]])

        def project(vectors):
            for _ in range(2):
                vectors = vectors - fixed @ (fixed.T @ vectors)
            return vectors

        corrections = minres(product, theta[:active], -project(residuals[:, :active]), project, INNER)
        known = np.hstack([locked, basis])
        added = extended(known, corrections, rng)
        basis, images = np.hstack([basis, added]), np.hstack([images, product(added)])


def extended(known: np.ndarray, corrections: np.ndarray, rng) -> np.ndarray:
    """Orthonormal directions of the corrections outside the known space, a random one if none is left."""
    room = known.shape[0] - known.shape[1]
    out = known
    lengths = np.linalg.norm(corrections, axis=0)
    for column in [*(corrections / np.where(lengths > 0, lengths, 1)).T, *rng.standard_normal((2, known.shape[0]))]:
        if out.shape[1] - known.shape[1] == room:
            break
        length = 1.0
        for _ in range(3):
            column = column - out @ (out.T @ column)
            size = np.linalg.norm(column)
            length *= size
            if size == 0 or length < 1e-8:
                break
            column = column / size
        if length >= 1e-8:
            out = np.hstack([out, column[:, None]])
        if out.shape[1] - known.shape[1] >= corrections.shape[1]:
            break
    return out[:, known.shape[1]:]


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 8) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of every row and leading principal component.

    An entry c becomes the integer x = floor(1024 c) + 100000. The n vectors that take part give the sums S and the
    covariance, divisor n. whitened is (x - S/n) on the component over the root of its eigenvalue, deviation the exact sum
    of (n x - S)^2 (null beyond 64 bits), explained the eigenvalue's share of the trace, identity_error the largest entry of
    the whitened covariance less the identity, all computed over the whole fit list.

    No part take vectors that are null, hold null or non-finite entries or such beyond 2^42, or differ in length from
    most (of lengths equally frequent the smaller counts; empty vectors never). Components without variance (one vector,
    equal vectors, more components than dimensions) have no rows. Null keys and repeated rows appear like others, an empty
    table gives no rows, other columns are ignored.

    Packed blocks of integers are written once; each product with the covariance is one pass over them that sends one matrix of
    dimensions x vectors per task.
    """
    given = rows.select(F.struct(rows[key].alias(key)).alias("_row"), rows[vector].cast("array<double>").alias("_vector"))
    result = fields_and([given.schema["_row"]], (
        "component int, n long, deviation long, whitened double, explained double, identity_error double"))
    out = ["_row." + key, *result.names[1:]]
    fit = fit_list(given)
    trace = 0
    if fit is not None:
        count, sums, width = fit.count, fit.sums, fit.width
        trace = float(fit.summed(lambda block: np.array([np.einsum("ij,ij->", block, block)]))[0]) / count
    if not trace:
        return rows.sparkSession.createDataFrame([], result).select(*out)
    values, axes = jacobi_davidson(fit.covariance_times, width, components)
    axes, values = axes[:, values > width * np.finfo(float).eps * values[0]], values[values > width * np.finfo(float).eps * values[0]]
    scaled = axes / np.sqrt(values)
    means = (fit.summed(lambda block: (block @ scaled).sum(axis=0)) / count).astype(np.float64)

    def spread(block):
        white = block @ scaled - means
        return white.T @ white

    error = float(np.abs(fit.summed(spread) / count - np.eye(len(values))).max())
    explained = (values / trace).tolist()

    def run(batches):
        release_model()
        for batch in batches:
            places, block = integers(batch.column(1), width)
            if not len(places):
                continue
            apart = differences(block, count, sums)
            white = (apart.astype(np.float64) / count) @ scaled
            squares = [int(d) for d in np.square(apart.astype(object)).sum(axis=1)] if wide(apart) else np.square(apart).sum(axis=1).tolist()
            squares = [d if d < 1 << 63 else None for d in squares]
            number = len(values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(places, number))), pa.array(np.tile(np.arange(1, number + 1), len(places)), pa.int32()),
                 pa.array(np.full(len(places) * number, count), pa.int64()), pa.array([d for d in squares for _ in range(number)], pa.int64()),
                 pa.array(white.ravel()), pa.array(explained * len(places), pa.float64()), pa.array(np.full(len(places) * number, error))],
                names=result.names)

    return map_batches(given, run, result).select(*out)


def wide(apart: np.ndarray) -> bool:
    """Whether sums of squares may leave 64 bits."""
    return apart.dtype == object or float(np.abs(apart).max(initial=0)) ** 2 * apart.shape[1] >= 2.0 ** 62
