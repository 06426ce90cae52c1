"""Tokenizer operators against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import docs
from voltide.llm import packing, token_files
from voltide.llm.bpe import ByteBpe, WordBpe, loaded
from voltide.llm.common import scratch_path
from voltide.llm.queries import QUERIES
from voltide.llm.tree_bpe import decode_documents, digest_documents, encode_documents

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")

TEXTS = [
    "", " ", "  a  b ", "a\n b\t c<|endoftext|> d<|endoftext|>x", "It's  we'll 's 123 4567", "éèà 一二三 🙂🙂",
    "x\x1cy \x85  z\x00q", "İstanbul ΣΑΣ ẞ", "a" * 9000, " " * 9000, "ab" * 5000 + " tail", "=-" * 6000,
    "one two three " * 6000, "<|endoftext|>" * 3, "\ufeffbom", "e\u0301 accents",
]


def library(path, texts):
    whole = Tokenizer.from_file(path)
    return [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def texts():
    return dict(enumerate(TEXTS)) | {100: None}


def rows_of(texts):
    return [*texts.items(), (None, "no id"), (3, TEXTS[3])]


@pytest.mark.parametrize("size", [8, 37, 500])
def test_tree_gives_the_librarys_ids(size):
    bpe, rng = loaded(ByteBpe, BYTE), random.Random(size)
    for _ in range(60):
        letters = rng.choice(["ab", "the", "aé!'s", "xyz'll", "一二三", "  \n", "=-*", "ing tion"])
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 700)))
        text = rng.choice(["", "<|endoftext|>"]).join([text, text])
        assert bpe.tree_ids(text, size).tolist() == library(BYTE, [text])[0]


@pytest.mark.parametrize(("kind", "path"), [(ByteBpe, BYTE), (WordBpe, WORD)])
def test_quick_encoder_gives_the_librarys_ids(kind, path, spark, sf):
    texts = TEXTS + [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = loaded(kind, path).ids_of(texts)
    assert [g.tolist() for g in got] == library(path, texts)


def test_encode_and_decode(spark, texts):
    rows = rows_of(texts)
    encoded = encode_documents(docs(spark, rows, extra=True), BYTE, part=3000)
    plain = [t or "" for _, t in rows]
    want = sorted(zip([str(i) for i, _ in rows], library(BYTE, plain)))
    assert sorted((str(r["doc_id"]), list(r["ids"])) for r in encoded.collect()) == want
    decoded = sorted((str(r["doc_id"]), r["text"]) for r in decode_documents(encoded, BYTE).collect())
    assert decoded == sorted((str(i), t or "") for i, t in rows)


@pytest.mark.parametrize("part", [100, 65536])
def test_digests(spark, texts, part):
    got = {r["doc_id"]: r for r in digest_documents(docs(spark, texts.items()), BYTE, part).collect()}
    for (i, text), ids in zip(texts.items(), library(BYTE, [t or "" for t in texts.values()])):
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def check_packing(got, want, capacity):
    used = {}
    for r in got:
        ids = want[str(r["doc_id"])]
        piece = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
        assert len(piece) == r["length"] <= capacity
        assert zlib.crc32(piece) == r["ids_crc32"]
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        if r["piece"]:
            assert r["length"] == capacity
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return used


@pytest.mark.parametrize("capacity", [7, 64, 1024])
def test_packing_places_every_piece(spark, texts, capacity):
    rows = rows_of(texts)
    want = {str(i): [*ids, 2] for (i, _), ids in zip(rows, library(BYTE, [t or "" for _, t in rows]))}
    got = packing.pack_documents(docs(spark, rows, extra=True), BYTE, capacity).collect()
    used = check_packing(got, want, capacity)
    total = sum(len(want[str(i)]) for i, _ in rows)
    assert sum(r["length"] for r in got) == total
    assert len(used) <= 1.1 * total / capacity + 2
    for r in got:
        assert list(r["ids"]) == want[str(r["doc_id"])][r["start"] : r["start"] + r["length"]]


def test_plan_is_close_to_the_least():
    rng = random.Random(5)
    for _ in range(200):
        capacity = rng.choice([10, 33, 100])
        counts = {rng.randint(1, capacity): rng.randint(1, 40) for _ in range(rng.randint(1, 12))}
        slots = packing.plan(dict(counts), capacity)
        fill, seen = {}, {}
        for length, low, high, each, sequence, offset in slots:
            assert low == seen.get(length, 0)
            seen[length] = high
            for turn in range(high - low):
                fill.setdefault(sequence + turn // each, []).append((offset + turn % each * length, length))
        assert seen == counts
        for places in fill.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= capacity
            assert sum(n > capacity // 3 for _, n in places) <= 2
        least = -(-sum(n * c for n, c in counts.items()) // capacity)
        alone = sum(c for n, c in counts.items() if 2 * n > capacity)
        pairs = -(-sum(c for n, c in counts.items() if n > capacity // 3) // 2)
        assert len(fill) <= 1.25 * max(least, alone, pairs) + 1


def test_token_files_round_trip(spark, texts):
    rows = rows_of(texts)
    folder = scratch_path(spark, "test-tokens")
    token_files.write_tokens(docs(spark, rows, extra=True), WORD, folder)
    got = token_files.read_tokens(spark, folder).collect()
    want = [[*ids, 2] for ids in library(WORD, [t or "" for _, t in rows])]
    expected = sorted(((i is not None, i or 0), w) for (i, _), w in zip(rows, want))
    found = sorted(got, key=lambda r: r["start"])
    assert [(r["doc_id"] is not None, r["doc_id"] or 0) for r in found] == [k for k, _ in expected]
    at = 0
    for r in found:
        assert r["start"] == at
        assert r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4"))
        at += r["n_tokens"]
    assert sorted(list(r["ids"]) for r in found) == sorted(want)


def test_elias_fano():
    rng = np.random.default_rng(3)
    for n, top in ((0, 1), (1, 1), (5, 3), (1000, 10), (3000, 10**9), (700, 700)):
        values = np.sort(rng.integers(0, top, n))
        coded = token_files.EliasFano.of(values)
        data = coded.to_bytes()
        back, end = token_files.EliasFano.from_bytes(memoryview(b"xx" + data), 2)
        assert end == len(data) + 2
        assert back.all().tolist() == values.tolist()
        assert [back.select(i) for i in range(n)] == values.tolist()
        if n > 500:
            bits = 8 * (len(coded.low) + len(coded.high)) / n
            assert bits <= 3 + max(0, np.log2(top / n))


@pytest.mark.parametrize("name", ["op6_best_fit_packing", "op7_tree_bpe", "op9_token_files"])
def test_empty_table(spark, tmp_path, name):
    docs(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES[name](spark, str(tmp_path)).collect() == []


def test_the_plan_of_packing_starts_no_python_workers(spark, monkeypatch):
    made, create = [], type(spark).createDataFrame
    rows = docs(spark, [(1, "one two"), (2, "three"), (3, None)])

    def kept(self, *args, **named):
        made.append(create(self, *args, **named))
        return made[-1]

    monkeypatch.setattr(type(spark), "createDataFrame", kept)
    packing.pack_documents(rows, BYTE, 16).collect()
    assert [d.columns[0] for d in made] == ["length"]
    assert "PythonRDD" not in made[0]._jdf.queryExecution().toRdd().toDebugString()
    assert packing.pack_documents(rows.where("doc_id = 9"), BYTE, 16).collect() == []
