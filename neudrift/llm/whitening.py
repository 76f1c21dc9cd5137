"""Whitening of embeddings by the leading eigenvectors of their covariance, found with FEAST contour integration.

Two passes over the vectors give the covariance: number and sums, then products of centred entries, added up in
the tasks and again per entry. Only that matrix, of the vectors' dimension, is looked at as a whole.

Its leading eigenvalues are enclosed in intervals by inertia counts: the negative pivots of a symmetric
factorisation of V - s I say how many eigenvalues lie below s. In each interval a block of vectors is projected on
the eigenvectors by quadrature over a circle around the interval: a node z asks for the solution of the complex
system (z I - V) Y = B. The intervals' systems are solved in tasks of their own, the sums are orthonormalised, and
the Rayleigh-Ritz values and vectors of V in their span are the next block. An interval is done when it holds as
many converged values as its inertia count says, so that none is missed.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from neudrift.llm.common import map_arrow, settle

# Nodes of the quadrature on the upper half of a circle, and rounds of projection at most.
NODES, ROUNDS = 12, 24
# Eigenvalues nearer than this part of the largest possible one are projected on together.
CLUSTER = 1e-5
# An eigenvalue below this part of the trace counts as zero and has no component.
RELATIVE_ZERO = 1e-12
SHIFT, SCALE = 100_000, 1024
# Greater entries, far beyond any embedding's, are taken as this.
_LARGEST = 1 << 60


# Vectors

def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """`id` and `vector` of the rows whose vector and all of its entries are there and finite, entries as doubles."""
    vector = rows[f"`{vector_col}`"].cast("array<double>")
    frame = rows.select(rows[f"`{id_col}`"].alias("id"), vector.alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return frame.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & F.coalesce(fine, F.lit(False)))


def _matrix(vectors: pa.Array, dimension: int) -> np.ndarray:
    """Entries as the whole numbers that are whitened."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * values)
    return np.clip(scaled, -float(_LARGEST), float(_LARGEST)).astype(np.int64) + SHIFT


def _parts(batches, column: str, dimension: int, rows: int = 8192):
    for batch in batches:
        for at in range(0, len(batch), rows):
            part = batch.slice(at, rows)
            yield part, _matrix(part.column(column), dimension)


def sums(vectors: DataFrame) -> tuple[int, int, list[int]]:
    """Dimension, number and sums per entry of the vectors of the most frequent length; of two lengths that are
    equally frequent the greater counts."""
    sizes = vectors.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if sizes is None:
        return 0, 0, []
    dimension, n = sizes

    def run(batches):
        total = np.zeros(dimension, object)
        for _, x in _parts(batches, "vector", dimension):
            total += x.sum(axis=0, dtype=np.int64).astype(object) if np.abs(x).max() < 1 << 40 else x.astype(object).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(dimension), pa.int32()), pa.array([str(t) for t in total])], ["at", "total"])

    found = map_arrow(vectors.where(F.size("vector") == dimension).select("vector"), run, "at int, total string")
    found = found.groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    return dimension, n, [int(r.total) for r in sorted(found)]


def covariance(vectors: DataFrame, n: int, total: list[int]) -> np.ndarray:
    """Covariance with divisor n; entries are centred before they are multiplied.

    A task hands on its sums of products, the upper triangle row by row.
    """
    dimension = len(total)

    def run(batches):
        products = np.zeros((dimension, dimension))
        for _, x in _parts(batches, "vector", dimension):
            centred = _centred(x, n, total)
            products += centred.T @ centred
        at, to = np.triu_indices(dimension)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at * dimension + to, pa.int32()), pa.array(products[at, to])], ["at", "total"])

    found = map_arrow(vectors.select("vector"), run, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).toArrow()
    out = np.zeros(dimension * dimension)
    out[found["at"].to_numpy()] = found["total"].to_numpy() / n
    out = out.reshape(dimension, dimension)
    return out + np.triu(out, 1).T


def _centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """x - total / n: the whole part of the mean is taken off exactly, and then the rest."""
    whole = [t // n for t in total]
    rest = np.array([(t - w * n) / n for t, w in zip(total, whole)])
    return (x - np.array(whole, np.int64)).astype(float) - rest


# Eigenvalues

def count_below(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix below `shift`: the negative ones among the pivots, of one or two rows each,
    of its factorisation with diagonal pivoting."""
    a = matrix - shift * np.eye(len(matrix))
    alpha, negative, k, n = (1 + 17 ** 0.5) / 8, 0, 0, len(a)
    while k < n:
        rest = a[k:, k:]
        diagonal = np.abs(np.diag(rest))
        at = int(diagonal.argmax())
        off = np.abs(rest - np.diag(np.diag(rest)))
        most = off.max() if len(rest) > 1 else 0.0
        if diagonal[at] == 0 and most == 0:
            break  # what is left is zero: eigenvalues that equal the shift
        if diagonal[at] >= alpha * most:
            order, size = [at], 1
        else:
            order, size = list(np.unravel_index(int(off.argmax()), off.shape)), 2
        order = [k + int(i) for i in order]
        for j in range(size):
            i = order[j]
            a[[k + j, i]] = a[[i, k + j]]
            a[:, [k + j, i]] = a[:, [i, k + j]]
            order = [i if o == k + j else o for o in order]
        pivot, below = a[k:k + size, k:k + size], a[k + size:, k:k + size]
        if size == 1:
            negative += int(pivot[0, 0] < 0)
        else:
            # Its determinant is negative by the choice of the pivot, so it has one eigenvalue of either sign.
            negative += 1
        if len(below):
            a[k + size:, k + size:] -= below @ np.linalg.solve(pivot, below.T)
        k += size
    return negative


def intervals(matrix: np.ndarray, components: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside), falling, for intervals that hold the `components` largest eigenvalues.

    Eigenvalues are bracketed by bisection with inertia counts. Those closer to each other than CLUSTER of the
    spectrum's reach share an interval, and so do the ones below the last, as far as the next gap. An interval
    reaches out by half the smaller gap to its neighbours, so that the quadrature tells them apart.
    """
    n = len(matrix)
    reach = np.abs(matrix).sum(axis=1).max()
    near, top, floor = CLUSTER * reach, reach * 1.01, -reach * 1.01
    counted = {top: 0, floor: n}

    def above(shift):
        if shift not in counted:
            counted[shift] = n - count_below(matrix, shift)
        return counted[shift]

    def bracket(k):
        """Bounds of the k-th largest eigenvalue, an eighth of `near` apart, from the counts made so far."""
        low = max(s for s, c in counted.items() if c >= k)
        high = min(s for s, c in counted.items() if c < k)
        while high - low > near / 8:
            middle = (low + high) / 2
            if above(middle) >= k:
                low = middle
            else:
                high = middle
        return low, high

    clusters, k = [], 1  # (bottom, top, eigenvalues)
    while k <= n:
        low, high = bracket(k)
        if clusters and clusters[-1][0] - high <= near:
            clusters[-1] = low, clusters[-1][1], clusters[-1][2] + 1
        elif k > components:
            break
        else:
            clusters.append((low, high, 1))
        k += 1
    ends = [top + near] + [c[0] for c in clusters], [c[1] for c in clusters[1:]] + [high if k <= n else floor - near]
    out = []
    for at, (low, high, inside) in enumerate(clusters):
        over = ends[0][at] - high if at else float("inf")
        under = low - ends[1][at] if at + 1 < len(clusters) or k <= n else float("inf")
        reach_out = min(over, under) / 2
        reach_out = reach_out if np.isfinite(reach_out) else reach
        low, high = low - reach_out, high + reach_out
        assert above(low) - above(high) == inside
        out.append((low, high, inside))
    return out


def feast(spark: SparkSession, matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors in columns."""
    n, size = len(matrix), np.abs(matrix).max(initial=0)
    if not components or size == 0:
        return np.zeros(0), np.zeros((n, 0))
    found = intervals(matrix, components)
    random = np.random.default_rng(7)
    blocks = [random.standard_normal((n, min(n, 2 * inside + 4))) for _, _, inside in found]
    results: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for at in range(ROUNDS):
        # Rounding alone, and a little more for clusters that take many rounds.
        enough = (4e-15 if at < ROUNDS // 3 else 1e-13) * n ** 0.5 * size
        todo = [k for k in range(len(found)) if k not in results]
        if not todo:
            break
        for k, block in _projected(spark, matrix, {k: (found[k], blocks[k]) for k in todo}).items():
            basis, _ = np.linalg.qr(block)
            values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
            vectors = basis @ turn
            low, high, inside = found[k]
            # Directions that the projection left empty may give values inside, too, but never converged ones.
            residual = np.linalg.norm(matrix @ vectors - vectors * values, axis=0)
            here = (values > low) & (values < high) & (residual <= enough)
            if here.sum() == inside:
                results[k] = values[here], vectors[:, here]
            blocks[k] = vectors
    else:
        if len(results) < len(found):
            raise ArithmeticError("eigenvalues of the covariance did not converge")
    values = np.concatenate([results[k][0] for k in range(len(found))])
    vectors = np.concatenate([results[k][1] for k in range(len(found))], axis=1)
    order = np.argsort(-values)[:components]
    return values[order], vectors[:, order]


def _projected(spark, matrix, work) -> dict[int, np.ndarray]:
    """The blocks projected on the eigenvectors of their intervals, a task per interval.

    By symmetry the upper half of the circle is enough: the integral is the real part of its sum.
    """
    points, weights = np.polynomial.legendre.leggauss(NODES)
    shared = spark.sparkContext.broadcast((matrix, work))
    jobs = spark.createDataFrame([(k,) for k in work], "k int").repartition(len(work), "k")

    def run(batches):
        matrix, work = shared.value
        for batch in batches:
            for k in batch.column("k").to_pylist():
                (low, high, _), block = work[k]
                centre, radius, out = (low + high) / 2, (high - low) / 2, np.zeros(block.shape)
                for point, weight in zip(points, weights):
                    angle = np.exp(0.5j * np.pi * (point + 1))
                    system = (centre + radius * angle) * np.eye(len(matrix)) - matrix
                    out += (0.5 * weight * radius * angle * np.linalg.solve(system, block.astype(complex))).real
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([out.tobytes()], pa.binary())], ["k", "block"])

    rows = map_arrow(jobs, run, "k int, block binary").collect()
    shared.unpersist()
    return {r.k: np.frombuffer(r.block).reshape(work[r.k][1].shape) for r in rows}


# The operator

def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8) -> DataFrame:
    """(`id`, `component`, `n`, `deviation`, `whitened`, `explained`, `identity_error`), a row for every usable row
    of `rows` and component.

    An entry c becomes the whole number floor(1024 c) + 100000. Vectors that are null or empty or hold a null or an
    entry that is not finite are left out, and so are those of another length than most. Equal rows and rows
    without an id are vectors each; other columns are not read. There are `components` components, or fewer: one
    per dimension at most, and none for an eigenvalue that is zero (below 1e-12 of the trace). So an empty
    table, one vector or equal vectors give no rows. `deviation` is null where it needs more than 64 bits.
    """
    spark = rows.sparkSession
    vectors = usable(rows, id_col, vector_col)
    id_type = vectors.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, component int, n long, deviation long, whitened double"
    dimension, n, total = sums(vectors)
    vectors = vectors.where(F.size("vector") == dimension)
    v = covariance(vectors, n, total) if n else np.zeros((0, 0))
    values, axes = feast(spark, v, min(components, dimension))
    trace = float(np.trace(v))
    real = values > RELATIVE_ZERO * trace
    values, axes = values[real], axes[:, real]
    if not len(values):
        return spark.createDataFrame([], f"{schema}, explained double, identity_error double")
    scaled = axes / np.sqrt(values)

    def run(batches):
        k = len(values)
        for part, x in _parts(batches, "vector", dimension):
            out = _centred(x, n, total) @ scaled
            yield pa.RecordBatch.from_arrays([
                part.column("id").take(pa.array(np.repeat(np.arange(len(x)), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * k, n)),
                pa.array(_deviations(x, n, total), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k))),
                pa.array(out.ravel()),
            ], ["id", "component", "n", "deviation", "whitened"])

    whitened = map_arrow(vectors, run, schema)
    error = identity_error(vectors, n, total, scaled)
    shares = F.array(*[F.lit(float(e / trace)) for e in values])
    return whitened.withColumn("explained", F.get(shares, F.col("component") - 1)).withColumn("identity_error", F.lit(error))


def _deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sums of the squares of n x - total, exactly."""
    about = _centred(x, n, total) * n
    if np.square(about).sum(axis=1).max(initial=0) < 1 << 62 and n * float(np.abs(x).max(initial=0)) < 1 << 62:
        return np.square(n * x - np.array(total, np.int64)).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(total, object)) ** 2).sum(axis=1)
    return [int(d) if d < 1 << 63 else None for d in exact]


def identity_error(vectors: DataFrame, n: int, total: list[int], scaled: np.ndarray) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity.

    Every task centres its own part before it multiplies; parts are put together about the mean of all.
    """
    dimension, k = scaled.shape

    def run(batches):
        for _, x in _parts(batches, "vector", dimension):
            w = _centred(x, n, total) @ scaled
            mean = w.mean(axis=0)
            yield pa.RecordBatch.from_arrays([
                pa.array([len(w)], pa.int64()), pa.array([mean.tolist()]),
                pa.array([((w - mean).T @ (w - mean)).ravel().tolist()])], ["rows", "mean", "products"])

    parts = settle(map_arrow(vectors.select("vector"), run, "rows long, mean array<double>, products array<double>"))
    means = parts.agg(*[F.sum(F.col("rows") * F.col("mean")[i]) / n for i in range(k)]).first()

    def entry(i, j):
        apart = (F.col("mean")[i] - means[i]) * (F.col("mean")[j] - means[j])
        return F.sum(F.col("products")[i * k + j] + F.col("rows") * apart) / n - (1.0 if i == j else 0.0)

    return max(abs(e) for e in parts.agg(*[entry(i, j) for i in range(k) for j in range(i, k)]).first())
