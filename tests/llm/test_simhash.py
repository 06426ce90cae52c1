"""SimHash against all pairs."""

import numpy as np
import pandas as pd
import pytest
import xxhash

from tests.llm.helpers import by_id, docs, prose, words
from voltide.llm import components as parts
from voltide.llm import simhash
from voltide.llm.components import components
from voltide.llm.queries import QUERIES


def plain_fingerprint(text: str) -> int:
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, bits=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i, name in enumerate(ids):
        root = find(i)
        least[root] = min(least.get(root, name), name)
    return [least[find(i)] for i in range(len(fps))]


def variants(seed: int, count: int, n: int = 300):
    base = words(n, seed)
    for k in range(count):
        changed = list(base)
        changed[(k * 37) % n] = f"z{k}"
        yield " ".join(changed)


def table(spark, extra=False):
    texts = [prose(200, s) for s in range(40)] + list(variants(7, 40)) + ["", None, " \n", "A b", "a B", "one"]
    texts += [texts[0], texts[0], texts[3].upper()]
    return list(enumerate(texts, 1)), docs(spark, enumerate(texts, 1), extra)


@pytest.mark.parametrize("group", [simhash.GROUP, 6])
def test_agrees_with_all_pairs(spark, group):
    rows, df = table(spark, extra=True)
    got = by_id(simhash.near_duplicates(df, group=group))
    fps = [plain_fingerprint(t) for _, t in rows]
    want = plain_components([i for i, _ in rows], fps)
    assert [got[i]["fingerprint"] for i, _ in rows] == [format(f, "016x") for f in fps]
    assert [got[i]["component_id"] for i, _ in rows] == want


def test_query_agrees_with_all_pairs(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    got = by_id(QUERIES["op8_simhash_pivots"](spark, sf))
    fps = [plain_fingerprint(r["text"]) for r in rows]
    want = plain_components([r["doc_id"] for r in rows], fps)
    assert [got[r["doc_id"]]["component_id"] for r in rows] == want


def test_null_ids_and_empty_table(spark):
    got = simhash.near_duplicates(docs(spark, [(None, "a b c d e"), (5, "a b c d e"), (None, "other words here")]))
    assert sorted(str(r["component_id"]) for r in got.collect()) == ["5", "5", "None"]
    assert simhash.near_duplicates(docs(spark, [])).collect() == []


def test_pivots_never_lose_a_pair():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    other = base.copy()
    for _ in range(4):
        other ^= np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)
    refs = simhash.references(16)
    one, two = base[:, None], other[:, None]
    found = simhash.near(one, two, simhash.pivot_table(one, refs), simhash.pivot_table(two, refs), 4)
    assert len(found) == 400
    mixed = simhash.near(one[:-1], one[1:], simhash.pivot_table(one[:-1], refs), simhash.pivot_table(one[1:], refs), 4)
    assert len(mixed) == 0


def test_dropping_keeps_one_of_each_group(spark):
    rows = [(i, prose(200, i)) for i in range(1, 20)]
    rows += [(100 + k, t) for k, t in enumerate(variants(3003, 30))] + [(99, " ".join(words(300, 3003)))]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (5, rows[4][1]), (None, rows[0][1])]
    df = docs(spark, rows, extra=True)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [*range(1, 20), 99]
    assert kept.where("doc_id IS NULL").count() == 1
    assert simhash.drop_near_duplicates(docs(spark, [])).collect() == []


def jaccard(one, two):
    a, b = ({tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in (one, two))
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("most", [simhash.MOST_SHINGLES, 2000])
def test_documents_below_the_similarity_stay(spark, most):
    """Spread changes: five shingles each. Below 0.8 all stay, also where others of the group go."""
    rows, want = [], []
    for k in range(30):
        base = words(300, 8000 + k)
        rows.append((10 * k, " ".join(base)))
        want.append(10 * k)
        for j, count in enumerate((3, 4, 8, 10, 13), 1):
            other = list(base)
            for c in range(count):
                other[5 + 20 * c + j] = f"z{k}x{j}x{c}"
            rows.append((10 * k + j, " ".join(other)))
            now = jaccard(rows[-1][1], rows[-1 - j][1])
            assert now >= 0.8 if count <= 4 else 0.6 < now < 0.8
            if count > 4:
                want.append(10 * k + j)
    kept = simhash.drop_near_duplicates(docs(spark, rows), most=most).collect()
    assert sorted(r["doc_id"] for r in kept) == want


def test_components_of_a_long_path_and_a_star(spark):
    pairs = [(k, k + 1) for k in range(1, 40)] + [(1000, k) for k in range(1001, 1100)] + [(7, 7), (2, 1)]
    edges = spark.createDataFrame(pd.DataFrame(pairs, columns=["a", "b"]))
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {k: 1000 for k in range(1000, 1100)}


def test_rounds_of_components_store_few_files(spark, monkeypatch):
    """A round stores a file for each task at once, not for each part of a shuffle."""
    files, stored = [], parts.materialize

    def counted(df, label):
        made = stored(df, label)
        files.append(len(made.inputFiles()))
        return made

    monkeypatch.setattr(parts, "materialize", counted)
    held = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    pairs = pd.DataFrame([(10 * k + i, 10 * k + i + 1) for k in range(300) for i in range(5)], columns=["a", "b"])
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = components(spark.createDataFrame(pairs))
        got = {r["node"]: r["root"] for r in found.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {10 * k + i: 10 * k for k in range(300) for i in range(6)}
    most = spark.sparkContext.defaultParallelism
    assert len(files) > 2 and max(files[1:]) <= most < 97
    assert found.rdd.getNumPartitions() <= 2 * most


def test_parts_grow_with_the_links(spark):
    rows, most = spark.range(0, 1000, 1, 90), spark.sparkContext.defaultParallelism
    assert parts._in_files(rows, 10).rdd.getNumPartitions() == most
    assert parts._in_files(rows, (most + 3) * parts.LINKS).rdd.getNumPartitions() == most + 3
    assert parts._in_files(rows, 10**9).rdd.getNumPartitions() == 90
