import math

import numpy as np
import pytest

from neudrift.llm.queries import op11_whitening
from neudrift.llm.whitening import count_below, covariance, feast, intervals, sums, usable, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, id long, vector string, n long, component string"


def frame(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(k, v, 1, 2, "v", 3, "c") for k, v in enumerate(vectors)], schema).repartition(3)


def whole(vectors):
    return np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors], object)


def brute(vectors, components=8):
    """Rows as the contract states them, by numpy's own solver; signs are those of the first large entry."""
    x = whole(vectors)
    n, total = len(x), x.sum(axis=0)
    centred = ((n * x - total) / n).astype(float)
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    order = np.argsort(-values)[:components]
    values, axes = values[order], axes[:, order]
    deviation = [int(d) for d in ((n * x - total) ** 2).sum(axis=1)]
    return n, deviation, centred @ axes / np.sqrt(values), values / np.trace(v), v


def compare(found, vectors, ids, components=8):
    n, deviation, whitened, explained, _ = brute(vectors, components)
    assert len(found) == len(vectors) * whitened.shape[1]
    got = {(r.id, r.component): r for r in found}
    errors = {r.identity_error for r in found}
    assert len(errors) == 1 and errors.pop() < 1e-9
    for k in range(whitened.shape[1]):
        rows = [got[i, k + 1] for i in ids]
        assert {r.n for r in rows} == {n} and [r.deviation for r in rows] == deviation
        assert all(abs(r.explained / explained[k] - 1) < 1e-9 for r in rows)
        own = np.array([r.whitened for r in rows])
        sign = np.sign(own @ whitened[:, k])
        assert np.allclose(own * sign, whitened[:, k], atol=1e-7)


def test_against_numpy(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.standard_normal((300, 12)) * np.linspace(1, 3, 12) + rng.standard_normal(12) * 30).astype(np.float32)
    vectors[100:200] = vectors[100]  # a common vector
    rows = [v.tolist() for v in vectors]
    compare(whiten(frame(spark, rows)).collect(), rows, range(300))
    compare(whiten(frame(spark, rows), components=20).collect(), rows, range(300), 12)


def test_rows_left_out(spark):
    rng = np.random.default_rng(2)
    rows = rng.standard_normal((40, 5)).astype(np.float32).tolist()
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [1.0, 2.0]]
    docs = frame(spark, rows + bad)
    compare(whiten(docs).collect(), rows, range(40), 5)
    twice = docs.unionByName(docs.where("vec_id = 3"))
    assert sum(r.id == 3 for r in whiten(twice).collect()) == 10


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 9, [None, []]])
def test_no_components(spark, vectors):
    found = whiten(frame(spark, vectors))
    assert found.collect() == []
    assert found.columns == ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_low_rank_and_large_entries(spark):
    rows = [[float(k % 7), float(2 * (k % 7)), 5.0, 1e30 if k == 3 else 1.0] for k in range(30)]
    found = whiten(frame(spark, rows)).collect()
    assert {r.deviation for r in found} == {None} or all(r.deviation is None or r.deviation >= 0 for r in found)
    rows = [[float(k % 7), float(2 * (k % 7)), 5.0] for k in range(30)]
    compare([r for r in whiten(frame(spark, rows)).collect()], rows, range(30), 1)


def matrices():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    spectra = {
        "spread": np.geomspace(1e6, 1e-3, 40), "equal": np.full(40, 7.0), "pairs": np.repeat(np.arange(20, 0, -1.0), 2),
        "cluster": np.r_[100.0, 50, 10 + 1e-9 * np.arange(12), np.linspace(1, 2, 26)],
        "rank three": np.r_[9.0, 8, 7, np.zeros(37)], "close": 100 + np.arange(40) * 1e-4, "one": np.r_[5.0, np.zeros(39)],
    }
    return {name: (q * s) @ q.T for name, s in spectra.items()} | {"diagonal": np.diag(np.arange(40.0)), "small": np.eye(2)}


@pytest.mark.parametrize("name", list(matrices()))
def test_feast(spark, name):
    v = matrices()[name]
    v = (v + v.T) / 2
    want = np.linalg.eigvalsh(v)[::-1]
    parts = intervals(v, 8)
    assert sum(inside for *_, inside in parts) >= min(8, len(v))
    for low, high, inside in parts:
        assert inside == ((want > low) & (want < high)).sum()
    values, axes = feast(spark, v, 8)
    size = np.abs(v).max()
    assert len(values) == min(8, len(v)) and np.allclose(values, want[:8], atol=1e-12 * size * len(v))
    assert np.allclose(axes.T @ axes, np.eye(len(values)), atol=1e-12)
    assert np.abs(v @ axes - axes * values).max() < 1e-11 * size


def test_inertia():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 4, 5, 8, 30, 31):
        a = rng.standard_normal((n, n))
        a = a + a.T
        a[np.arange(n), np.arange(n)] *= n % 2  # even sizes need pivots of two rows
        values = np.linalg.eigvalsh(a)
        for shift in np.r_[0.0, rng.standard_normal(40) * 3]:
            if np.abs(values - shift).min() > 1e-9:
                assert count_below(a, shift) == (values < shift).sum()


def test_covariance_is_exact_far_from_zero(spark):
    rows = [[90.0 + (k % 2) / 1024, 0.5 * k / 1024] for k in range(1000)]
    vectors = usable(frame(spark, rows), "vec_id", "embedding")
    dimension, n, total = sums(vectors)
    assert (dimension, n, total) == (2, 1000, [int(t) for t in whole(rows).sum(axis=0)])
    assert np.allclose(covariance(vectors, n, total), brute(rows, 2)[-1], rtol=1e-13)


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    rows = [r for r in rows if r.embedding and all(c is not None and math.isfinite(c) for c in r.embedding)]
    found = op11_whitening(spark, sf_dir).withColumnRenamed("vec_id", "id").collect()
    compare(found, [r.embedding for r in rows], [r.vec_id for r in rows])
