"""Context-tree weighting against a plain version with dictionaries."""

import collections
import math
import zlib

import numpy as np
import pytest

from tests.llm.helpers import by_id, docs, prose
from voltide.llm import context_tree as tree


def decisions(text: bytes, depth: int):
    data = bytes(depth) + text + b"\0"
    for p in range(depth, len(data)):
        for k in range(8):
            yield data[p - depth : p], (1 << k) | (data[p] >> (8 - k)), (data[p] >> (7 - k)) & 1


class Plain:
    def __init__(self, texts, depth):
        self.depth, self.counts = depth, collections.defaultdict(lambda: [0, 0])
        for t in texts:
            for context, node, value in decisions(t, depth):
                for d in range(depth + 1):
                    self.counts[context[depth - d :], node][value] += 1
        below, self.weight = collections.defaultdict(float), {}
        for key in sorted(self.counts, key=lambda k: -len(k[0])):
            a, b = self.counts[key]
            own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
            whole, self.weight[key] = own, 1.0
            if len(key[0]) < depth:
                whole = np.logaddexp(own, below[key]) + math.log(0.5)
                self.weight[key] = math.exp(own + math.log(0.5) - whole)
            if key[0]:
                below[key[0][1:], key[1]] += whole

    def score(self, text: bytes) -> float:
        total = 0.0
        for context, node, value in decisions(text, self.depth):
            chance = 0.0
            for d in range(self.depth, -1, -1):
                key = context[self.depth - d :], node
                counts = self.counts.get(key, (0, 0))
                weight = self.weight.get(key, 1.0 if d == self.depth else 0.5)
                chance = weight * (counts[value] + 0.5) / (sum(counts) + 1) + (1 - weight) * chance
            total += math.log10(chance)
        return total


@pytest.mark.parametrize(("depth", "block"), [(2, 300), (3, 10**6), (tree.DEPTH, 2000)])
def test_agrees_with_the_plain_version(spark, depth, block):
    texts = [prose(25, k % 9) + ". Été!" for k in range(24)] + ["", None, "\0\0", "ABC abc", "x" * 500]
    rows = [*enumerate(texts), (None, "no id here"), (3, texts[3])]
    got = by_id(tree.score_documents(docs(spark, rows, extra=True), depth, block))
    plain = [(i, (t or "").encode().lower()) for i, t in rows]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    train = [t for i, t in plain if not held[i]]
    model, counts = Plain(train, depth), collections.Counter()
    for t in train:
        counts.update([*t.split(), None])
    n, v = sum(counts.values()), len(counts)
    for i, t in plain:
        tokens, r = [*t.split(), None], got[i]
        assert r["held_out"] == held[i] and r["train_tokens"] == n
        assert r["n_tokens"] == len(tokens) and r["n_known"] == sum(counts[w] > 0 for w in tokens)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens))
        assert r["score"] == pytest.approx(model.score(t), rel=1e-5, abs=1e-6)
        assert r["bits_per_byte"] == pytest.approx(-r["score"] * math.log2(10) / (len(t) + 1))


def test_predictions_sum_to_one():
    texts = [prose(40, k).encode() for k in range(6)]
    runs = np.concatenate([tree.runs_of(t, 3) for t in texts])
    names, counts = np.unique(runs, return_counts=True)
    context = names[50] >> np.uint64(8)
    every = (context << np.uint64(8)) | np.arange(256, dtype=np.uint64)
    both = np.unique(np.concatenate([names, every]))
    total = np.zeros(len(both))
    total[np.searchsorted(both, names)] = counts
    found = tree.subtree(both, total, 3)[1]
    level = [((f[0] >> np.uint64(16)) << np.uint64(8) | (f[0] & np.uint64(255))).astype(np.int64) for f in found]
    top = tree.Top(np.concatenate(level), *[np.concatenate([f[i] for f in found]) for i in (1, 2, 3)])
    logs = tree.log_chances(both, total, top, 3)
    assert sum(10 ** logs[np.searchsorted(both, every)]) == pytest.approx(1.0)


def test_long_text_in_slices(monkeypatch, spark):
    rows = [(k, prose(400, k % 3)) for k in range(6)]
    want = by_id(tree.score_documents(docs(spark, rows)))
    monkeypatch.setattr(tree, "SLICE", 100)
    pieces = list(tree._run_slices([t.encode() for _, t in rows], tree.DEPTH))
    assert len(pieces) > 20
    joined = np.concatenate([r for _, r in pieces])
    assert (joined == np.concatenate([tree.runs_of(t.encode(), tree.DEPTH) for _, t in rows])).all()
    assert want[0]["score"] < 0


def test_it_learns(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    got = tree.score_documents(rows).where("held_out").toPandas()
    assert np.average(got["bits_per_byte"]) < 3.2


def test_log_gamma():
    x = np.r_[0.5, 1, 1.5, 2, 7.25, 100, 1e6]
    assert np.allclose(tree.log_gamma(x), [math.lgamma(v) for v in x], atol=1e-9, rtol=1e-12)


def test_packing():
    rng = np.random.default_rng(0)
    values = np.sort(rng.integers(0, 2**63, 500, dtype=np.uint64))
    assert (tree.unpack_sorted(tree.pack_sorted(values)) == values).all()
    assert len(tree.unpack_sorted(tree.pack_sorted(values[:0]))) == 0


def test_empty_table(spark):
    assert tree.score_documents(docs(spark, [])).collect() == []
