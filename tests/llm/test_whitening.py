"""Whitening against numpy on whole numbers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltide.llm.queries import QUERIES
from voltide.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(vectors, k=32):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    apart = n * x - s
    centred = apart / n
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    return (apart**2).sum(axis=1), (centred @ vecs / np.sqrt(values))[:, :k], (values / values.sum())[:k]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS index", "1 AS n", "2 AS x", "'v' AS v")


def sample(n=300, width=12, seed=3):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((n, width)) * np.linspace(1, 4, width) @ rng.standard_normal((width, width))


def check(got, ids, vectors, k=32):
    deviation, whitened, explained = plain(vectors, k)
    by_id = {r["vec_id"]: r for r in got}
    assert sorted(by_id) == sorted(ids) and len(got) == len(ids)
    found = np.array([by_id[i]["whitened"] for i in ids])
    sign = np.sign((found * whitened).sum(axis=0))
    np.testing.assert_allclose(found * sign, whitened, rtol=1e-7, atol=1e-9)
    assert [by_id[i]["deviation"] for i in ids] == deviation.tolist()
    for r in got:
        assert r["n"] == len(ids) and r["identity_error"] < 1e-9
        np.testing.assert_allclose(r["explained"], explained, rtol=1e-9)


@pytest.mark.parametrize("block", [2048, 7])
def test_agrees_with_numpy(spark, block):
    x = sample()
    rows = [(k, v.tolist(), k % 3) for k, v in enumerate(x)]
    odd = [(900, None, 1), (901, [None] * 12, 1), (902, [float("nan")] * 12, 1), (903, [float("inf")] * 12, 1),
           (904, [1.0, 2.0], 1), (905, [], 1)]
    got = whiten(table(spark, rows + odd).repartition(5), rows_per_block=block).collect()
    check(got, list(range(len(x))), x)


def test_fewer_components_than_asked_and_wide_vectors(spark, monkeypatch):
    from voltide.llm import whitening

    monkeypatch.setattr(whitening, "COLUMNS_PER_BLOCK", 5)
    x = sample()
    got = whiten(table(spark, [(k, v.tolist(), 0) for k, v in enumerate(x)]), components=4, rows_per_block=50).collect()
    check(got, list(range(len(x))), x, 4)


def test_large_ids_nulls_and_repeated_rows(spark):
    x = sample(40, 3)
    rows = [(2**60 + 1, x[0].tolist(), 0), (None, x[1].tolist(), 0), (2**60 + 3, x[0].tolist(), 0)]
    rows += [(k, v.tolist(), None) for k, v in enumerate(x)] + [(5, x[5].tolist(), 1)]
    got = whiten(table(spark, rows)).collect()
    ids = [r["vec_id"] for r in got]
    assert len(got) == 44 and {2**60 + 1, 2**60 + 3, None} <= set(ids) and ids.count(5) == 2
    same = [tuple(r["whitened"]) for r in got if r["vec_id"] in (2**60 + 1, 2**60 + 3, 0)]
    assert len(set(same)) == 1


def test_no_variance_and_empty_tables(spark):
    assert whiten(table(spark, [])).collect() == []
    assert whiten(table(spark, [(1, None, 1)])).collect() == []
    one = whiten(table(spark, [(1, [0.5, 2.0], 1)])).collect()[0]
    assert (one["n"], one["deviation"], one["whitened"], one["explained"]) == (1, 0, [None, None], [None, None])
    flat = [(k, [float(k), 7.0, -float(k)], 1) for k in range(9)]
    for r in whiten(table(spark, flat)).collect():
        assert r["whitened"][1:] == [None, None] and abs(r["whitened"][0]) < 2 and r["identity_error"] < 1e-9
        assert r["explained"][0] == pytest.approx(1.0) and r["explained"][2] < 1e-9


def test_huge_entries(spark):
    x = [[1e300, 1.0], [-1e300, 2.0], [2.0, 3.0], [1e-310, 4.0]]
    got = whiten(table(spark, [(k, v, 0) for k, v in enumerate(x)])).collect()
    assert len(got) == 4 and all(np.isfinite([c for c in r["whitened"] if c is not None]).all() for r in got)
    assert [r["deviation"] for r in sorted(got, key=lambda r: r["vec_id"])][:2] == [None, None]


def test_query_agrees_with_numpy(spark, sf):
    from voltide.llm.common import table as read

    rows = read(spark, sf, "embeddings").orderBy("vec_id").collect()
    deviation, whitened, explained = plain([r["embedding"] for r in rows])
    got = QUERIES["op12_block_whitening"](spark, sf)
    assert got.columns[:5] == ["vec_id", "component", "n", "deviation", "whitened"]
    assert dict(got.dtypes)["component"] == "int" and dict(got.dtypes)["deviation"] == "bigint"
    got = got.orderBy("vec_id", "component").collect()
    assert len(got) == len(rows) * 32
    found = np.array([r["whitened"] for r in got]).reshape(-1, 32)
    sign = np.sign((found * whitened).sum(axis=0))
    np.testing.assert_allclose(found * sign, whitened, rtol=1e-6, atol=1e-8)
    assert [r["deviation"] for r in got[::32]] == deviation.tolist()
    np.testing.assert_allclose([r["explained"] for r in got[:32]], explained, rtol=1e-8)
    assert max(r["identity_error"] for r in got) < 1e-9
