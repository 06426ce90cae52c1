"""Embedding forest against SQL and all pairs."""

import numpy as np
import pytest

from tests.compare import connect, differences
from voltide.llm import tree_forest
from voltide.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def clusters(seed=0, groups=30, each=12, dim=16, noise=0.05):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((groups, dim))
    x = np.repeat(centers, each, axis=0) + noise * rng.standard_normal((groups * each, dim))
    return x.astype(np.float32)


def plain(rows, least=0.93):
    sound = {
        i: np.array(v, np.float64) for i, v, label in rows
        if label is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)
    }
    label = {i: lab for i, _, lab in rows}
    links = {i: set() for i, _, _ in rows}
    for a in sound:
        for b in sound:
            if a != b and label[a] == label[b] and len(sound[a]) == len(sound[b]):
                x, y = sound[a], sound[b]
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    links[a].add(b)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for n in links[todo.pop()] - seen:
                seen.add(n)
                todo.append(n)
        out[i] = (len(links[i]), min(seen), i == min(seen))
    return out


def result(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


@pytest.mark.parametrize(("leaf", "group"), [(1024, 6000), (20, 6000), (60, 10)])
def test_agrees_with_all_pairs(spark, leaf, group):
    x = clusters()
    rows = [(k, v.tolist(), k % 3) for k, v in enumerate(x)]
    rows += [(1000 + k, x[5].tolist(), 2) for k in range(15)]  # copies
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] * 16, 1), (2003, [None] * 16, 1)]
    rows += [(2004, x[0].tolist(), None), (2005, [1.0, 2.0], 1), (2006, [2.0, 4.0], 1), (2007, [], 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS node", "'y' AS links")
    assert result(tree_forest.near_vectors(df, leaf=leaf, group=group)) == plain(rows)


def test_query_agrees_with_sql(spark, sf):
    df = QUERIES["op1_projection_forest"](spark, sf)
    assert differences(df, connect(sf), ORACLES["op1_projection_forest"]) == []


def test_sample_is_bounded_and_recall_holds(spark):
    x = clusters(seed=4, groups=150, each=8)
    rows = [(k, v.tolist(), 0) for k, v in enumerate(x)]
    got = result(tree_forest.near_vectors(spark.createDataFrame(rows, SCHEMA), leaf=40, sample=300))
    want = plain(rows)
    found = sum(v[0] for v in got.values())
    assert found <= sum(v[0] for v in want.values())
    assert found >= 0.99 * sum(v[0] for v in want.values())


def test_few_copies_of_a_vector_are_sent(spark, monkeypatch):
    """A label that one task does not hold is sent tree by tree, and nothing is lost or counted twice."""
    x = clusters(seed=7, groups=400, each=10, noise=0.2)
    u = x / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    want = (u @ u.T >= 0.93).sum(axis=1) - 1
    df = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)], SCHEMA)
    sent, frame = [], type(df)
    deal = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, *a: sent.append(self.count()) or deal(self, *a))
    got = result(tree_forest.near_vectors(df, leaf=100, group=1000))
    found = np.array([got[k][0] for k in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.998 * want.sum() > 0
    assert len(sent) == tree_forest.CELL_TREES and len(x) <= max(sent) <= 3 * len(x)


@pytest.mark.parametrize("leaf", [2048, 50])
def test_dense_clusters_are_compared_in_full(leaf):
    """Where the overlap makes a split a loss, no pair is lost."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal(64) / 8 + 0.05 * rng.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for least in (0.84, 0.87):
        margin = tree_forest.margin_of(64, least, tree_forest.OVERLAP)
        pairs = [np.stack(p, axis=1) for p in tree_forest._pairs(x, least, leaf, margin, tree_forest.TREES)]
        pairs = np.sort(np.concatenate(pairs), axis=1)
        want = np.argwhere(np.triu(x @ x.T >= least, 1))
        assert len(np.unique(pairs, axis=0)) == len(pairs) and len(pairs) >= 0.998 * len(want) > 0


def test_null_ids_and_empty_table(spark):
    rows = [(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1)]
    got = tree_forest.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r["n_links"], r["component_id"]) for r in got] == [(2, 4)] * 3
    assert tree_forest.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
