"""Whitening of embeddings."""

import numpy as np
import pytest

from vesselmart.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def _vectors(spark, rows):
    return spark.createDataFrame([(k, v, 0) for k, v in rows], SCHEMA)


def _plain(rows, components=16):
    """Fit list and model by plain integer arithmetic and numpy."""
    x = {k: [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for k, v in rows}
    fit = np.array(sorted(set(map(tuple, x.values()))), object)
    n, total = len(fit), fit.sum(axis=0)
    centred = fit * n - total
    covariance = ((centred.T @ centred) / n**3).astype(float)
    e, p = np.linalg.eigh(covariance)
    return x, n, total, e[::-1][:components], p[:, ::-1][:, :components], np.trace(covariance)


def test_whitening_agrees_with_plain_arithmetic(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(700, 20)) @ draw.normal(size=(20, 20)) + 3
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(1000 + k, rows[5][1]) for k in range(300)] + [(7, rows[9][1])]  # a hot vector, a repeated id
    x, n, total, e, p, trace = _plain(rows[:1000])
    got = whitening.whiten(_vectors(spark, rows).repartition(7)).toPandas()
    assert len(got) == len(rows) * 16 and set(got.n) == {n} == {700}
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    by_row = got[(got.vec_id < 700) & (got.vec_id != 7)].set_index(["vec_id", "component"])
    sign = None
    for k in range(0, 700, 37):
        centred = np.array([n * a - s for a, s in zip(x[k], total)], object)
        mine = by_row.loc[k].sort_index()
        assert set(mine.deviation) == {int((centred * centred).sum())}
        want = (centred / n).astype(float) @ p / np.sqrt(e)
        if sign is None:
            sign = np.sign(want) * np.sign(mine.whitened.to_numpy())
        np.testing.assert_allclose(mine.whitened.to_numpy() * sign, want, rtol=1e-6, atol=1e-8)
        np.testing.assert_allclose(mine.explained.to_numpy(), e / trace, rtol=1e-9)


def test_cross_products_are_exact_over_any_range():
    draw = np.random.default_rng(4)
    for top in (1, 50, 2**20, 2**30):
        rows = draw.integers(-top, top, size=(200, 5))
        rows[:, 3] = 7  # no spread
        rows = rows.astype(np.int64)
        wide = rows.astype(object)
        assert (whitening.cross_products(rows) == wide.T @ wide).all()


def test_edges_of_whitening(spark):
    nan, inf = float("nan"), float("inf")
    odd = [
        (1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [1.0, -inf]), (6, [1.0, 2.0, 3.0]),
        (None, [0.5, 1.0]), (8, [0.25, -1.0]), (8, [0.25, -1.0]), (9, [2.0, 4.0]),
    ]
    got = whitening.whiten(_vectors(spark, odd).withColumnRenamed("label", "whitened")).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == [
        (0, 1), (0, 2), (8, 1), (8, 1), (8, 2), (8, 2), (9, 1), (9, 2)
    ]
    assert {r["n"] for r in got} == {3} and sum({r["component"]: r["explained"] for r in got}.values()) == pytest.approx(1)
    # no variance, no components
    assert whitening.whiten(_vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    # one direction only: one component
    line = [(k, [float(k), 2.0 * k, 1.0]) for k in range(20)]
    assert whitening.whiten(_vectors(spark, line)).count() == 20
    assert whitening.whiten(_vectors(spark, [])).count() == 0
    with pytest.raises(Exception, match="2\\*\\*25"):
        whitening.whiten(_vectors(spark, [(1, [4e7, 1.0])])).collect()
