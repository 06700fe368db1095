"""Principal components and whitened coordinates of integer vectors, by Lanczos bidiagonalisation.

The centred vectors are the rows of a matrix X that never leaves the tasks. Each step of
the Golub-Kahan-Lanczos process is one pass over it: from a direction v come the long
vector u = Xv and the short one X'u. A long vector is a combination of the rows' own
dimensions, u = Xw, so only w is kept (by the driver, as long as one vector), and every
task makes its part of u and of all earlier ones anew. Both kinds of vectors are made
orthogonal to all earlier ones in every step. The small bidiagonal matrix that results
has the singular values of X, and its singular vectors give the components.

Up to FULL_STEPS dimensions the process runs to the end and starts afresh wherever it
breaks off, so that equal deviations are all found. Wider vectors stop when the leading
components have converged; of deviations that are exactly equal among these, one each
is found.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.scale import mapped
from gaugeflow.session import written

BLOCK_BYTES = 1 << 20
FULL_STEPS = 256
# Relative to the largest singular value: what counts as nothing.
NOTHING = 1e-11
CONVERGED = 1e-13
LONGEST_LONG = 2**63 - 1


@dataclass
class Fit:
    """What a fit knows: rows, exact sums, components (columns), their variances, the total one."""

    n: int
    sums: list
    components: np.ndarray
    variances: np.ndarray
    total: float

    def centre(self):
        """The mean as whole numbers and the rests, which are below 1."""
        low = [s // self.n for s in self.sums]
        return low, np.array([(s - self.n * m) / self.n for s, m in zip(self.sums, low)])


def usual_length(vectors: DataFrame, vector_col) -> int:
    """The most frequent length of a vector, the greater of two; 0 if there are none."""
    counted = vectors.groupBy(F.size(vector_col).alias("d")).agg(F.count("*").alias("n"))
    first = counted.where("d > 0").orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return first[0].d if first else 0


def blocked(vectors: DataFrame, d, id_col, vector_col) -> DataFrame:
    """Rows of length `d` as blocks of about BLOCK_BYTES: their ids, number and 64-bit entries; written."""
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<bigint>").alias("x"))
    rows = rows.where((F.size("x") == d) & ~F.exists("x", lambda v: v.isNull()))
    size = max(1, BLOCK_BYTES // (8 * max(1, d)))

    def pack(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, size):
                part = batch.slice(first, size)
                data = part.column("x").flatten().to_numpy(zero_copy_only=False).astype("<i8").tobytes()
                ids = part.column("id")
                offsets = pa.array([0, len(ids)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(offsets, ids), pa.array([len(ids)], pa.int64()),
                     pa.array([data], pa.binary())],
                    names=["ids", "n", "data"],
                )

    return written(mapped(rows, pack, f"ids array<{kind}>, n long, data binary"), "vector-blocks")


def matrix(data, d):
    return np.frombuffer(data.as_buffer(), "<i8").reshape(-1, d)


def centred(x, low, rest):
    return (x - np.array(low, dtype=np.int64)).astype(np.float64) - rest


def added_up(blocks: DataFrame, function) -> np.ndarray:
    """The sum over all blocks of the array that `function` makes of a block's entries.

    Tasks add up their own blocks and send one number per place of the array.
    """

    def totals(batches):
        total = None
        for batch in batches:
            for data in batch.column("data"):
                own = function(data)
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["at", "v"]
            )

    parts = mapped(blocks.select("data"), totals, "at int, v double")
    rows = parts.groupBy("at").agg(F.sum("v").alias("v")).collect()
    return np.array([r.v for r in sorted(rows, key=lambda r: r.at)])


def exact_sums(blocks: DataFrame, d):
    """The number of rows and the exact sum per dimension."""

    def sums(batches):
        for batch in batches:
            for data in batch.column("data"):
                x = matrix(data, d)
                # Halves of 32 bits, so that no partial sum leaves 64 bits.
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(d, dtype=np.int32)), pa.array(high), pa.array(low)],
                    names=["at", "high", "low"],
                )

    halves = mapped(blocks.select("data"), sums, "at int, high long, low long")
    big = {c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")}
    rows = halves.groupBy("at").agg(*big.values()).collect()
    n = blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return n, [(int(r.high) << 32) + int(r.low) for r in sorted(rows, key=lambda r: r.at)]


def bidiagonalise(product, d, steps, enough):
    """Columns V and the bidiagonal B with X V = U B for orthonormal U, V.

    `product(p, w)` gives X'Xp followed by (Xw)'(Xp) for the columns of w. `enough(b, beta)`
    says whether the process may stop before `steps`.
    """
    rng = np.random.default_rng(0)
    v, w, z = (np.zeros((d, 0)) for _ in range(3))
    alphas, betas, scale = [], [], 0.0

    def fresh():
        """A random direction orthogonal to V, or None if V spans everything."""
        if v.shape[1] >= d:
            return None
        r = rng.standard_normal(d)
        for _ in range(3):
            r -= v @ (v.T @ r)
        return r / np.linalg.norm(r)

    direction, beta = fresh(), 0.0
    while direction is not None and len(alphas) < steps:
        p = direction - (beta * w[:, -1] if beta else 0.0)
        made = product(p, w)
        x, c = made[:d], made[d:]
        p, x = p - w @ c, x - z @ c
        # What rounding has left of the earlier long vectors: U'u is W'(X'u).
        c = w.T @ x
        p, x = p - w @ c, x - z @ c
        alpha = float(np.sqrt(max(p @ x, 0.0)))
        scale = max(scale, alpha)
        if alpha <= NOTHING * scale or alpha == 0.0:
            # A random direction that X maps to nothing: nothing is left anywhere.
            if beta == 0.0:
                break
            alpha = 0.0
        v = np.column_stack([v, direction])
        w = np.column_stack([w, p / alpha if alpha else np.zeros(d)])
        z = np.column_stack([z, x / alpha if alpha else np.zeros(d)])
        alphas.append(alpha)
        betas.append(beta)
        r = z[:, -1] - alpha * direction
        for _ in range(2):
            r -= v @ (v.T @ r)
        beta = float(np.linalg.norm(r))
        scale = max(scale, beta)
        b = np.diag(alphas) + np.diag(betas[1:], 1)
        if len(alphas) < d and enough(b, beta):
            break
        if v.shape[1] < d and beta > NOTHING * scale:
            direction = r / beta
        else:
            direction, beta = fresh(), 0.0
    return v, np.diag(alphas) + np.diag(betas[1:], 1) if alphas else np.zeros((0, 0))


def fit(blocks: DataFrame, d, components, full_steps=FULL_STEPS) -> Fit:
    """Components and variances of all rows of `blocks`; directions without variance have none."""
    n, sums = exact_sums(blocks, d)
    found = Fit(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0)
    if not n:
        return found
    low, rest = found.centre()

    def product(p, w):
        both = np.column_stack([p, w])

        def of_block(data):
            x = centred(matrix(data, d), low, rest)
            made = x @ both
            return np.concatenate([made[:, 0] @ x, made[:, 0] @ made[:, 1:]])

        return added_up(blocks, of_block)

    def enough(b, beta):
        if d <= full_steps or len(b) < 2 * components:
            return False
        left, values, _ = np.linalg.svd(b)
        return bool((beta * abs(left[-1, :components]) <= CONVERGED * values[0]).all())

    found.total = float(added_up(blocks, lambda data: (centred(matrix(data, d), low, rest) ** 2).sum(axis=0)).sum()) / n
    if found.total == 0.0:
        return found
    v, b = bidiagonalise(product, d, d, enough)
    _, values, right = np.linalg.svd(b)
    kept = min(components, int((values > NOTHING * values[0]).sum()) if len(values) else 0)
    found.components = v @ right[:kept].T
    found.variances = values[:kept] ** 2 / n
    return found


def whitened_rows(x, found: Fit):
    """Coordinates of rows along the components, divided by their deviations."""
    low, rest = found.centre()
    return centred(x, low, rest) @ found.components / np.sqrt(found.variances)


def identity_error(blocks: DataFrame, d, found: Fit) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(found.variances)

    def of_block(data):
        y = whitened_rows(matrix(data, d), found)
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    made = added_up(blocks, of_block)
    mean, second = made[:k] / found.n, made[k:].reshape(k, k) / found.n
    return float(abs(second - np.outer(mean, mean) - np.eye(k)).max())


def deviations(x, n, sums):
    """Sums over dimensions of (n * x - sum) squared, exact; None beyond a long."""
    low = [s // n for s in sums]
    rest = [s - n * m for s, m in zip(sums, low)]
    shifted = x - np.array(low, dtype=np.int64)
    most = n * int(abs(shifted).max(initial=0)) + n
    if most * most * x.shape[1] <= LONGEST_LONG:
        return (((n * shifted - np.array(rest, dtype=np.int64)) ** 2).sum(axis=1)).tolist()
    exact = [sum((n * int(v) - r) ** 2 for v, r in zip(row, rest)) for row in shifted]
    return [e if e <= LONGEST_LONG else None for e in exact]


def whiten(vectors: DataFrame, components=8, id_col="vec_id", vector_col="x") -> DataFrame:
    """Per row and component: id, component, n, deviation, whitened, explained, identity_error.

    `vectors` hold whole numbers. Rows whose vector is null, holds a null or is not of the
    usual length are dropped; all others are fitted and returned, with null ids and repeated
    rows as they are. `component` counts from 1 by falling variance, up to `components` or as
    many as have any variance: equal rows, one row and an empty table give an empty result.
    Equal variances have any orthonormal directions. `deviation` is the sum over dimensions
    of (n * x - sum) squared, null where that is beyond a long; `explained` is the share of
    the total variance. Numbers beyond 2**52 lose their last bits in `whitened`.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    d = usual_length(vectors, vector_col)
    blocks = blocked(vectors, d, id_col, vector_col)
    found = fit(blocks, d, components) if d else Fit(0, [], np.zeros((0, 0)), np.zeros(0), 0.0)
    k = len(found.variances)
    error = identity_error(blocks, d, found) if k else 0.0
    explained = found.variances / found.total if k else np.zeros(0)

    def rows(batches):
        for batch in batches:
            if not k:
                continue
            for ids, data in zip(batch.column("ids"), batch.column("data")):
                x = matrix(data, d)
                y, size = whitened_rows(x, found), len(x)
                at = pa.array(np.repeat(np.arange(size), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(at),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                        pa.array(np.full(size * k, found.n, dtype=np.int64)),
                        pa.array(deviations(x, found.n, found.sums), pa.int64()).take(at),
                        pa.array(y.ravel()),
                        pa.array(np.tile(explained, size)),
                        pa.array(np.full(size * k, error)),
                    ],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    schema = (
        f"id {kind}, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double"
    )
    return mapped(blocks.select("ids", "data"), rows, schema).withColumnRenamed("id", id_col)


def quantised(rows: DataFrame, vector_col, scale, shift, id_col="vec_id") -> DataFrame:
    """Rows as (id, x): x = floor(scale * entry) + shift of each entry as a double.

    Rows are dropped whose vector is null or holds an entry that is null, not finite, or
    too large for a long.
    """
    whole = F.transform(
        vector_col, lambda c: F.floor(c.cast("double") * scale).try_cast("bigint") + F.lit(shift)
    )
    usable = F.forall(
        vector_col, lambda c: F.coalesce(F.abs(c.cast("double") * scale) < F.lit(2.0**62), F.lit(False))
    )
    kept = rows.where(F.col(vector_col).isNotNull() & usable)
    return kept.select(F.col(id_col), whole.alias("x"))
