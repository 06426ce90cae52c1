"""Prediction by partial matching against a plain coder, and held-out accuracy."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import docs as plain_docs
from voltide.llm import ppm_language as ppm
from voltide.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


class Plain:
    """A coder with dictionaries and an explicit list of excluded bytes."""

    def __init__(self, pieces, depth):
        self.depth, self.seen = depth, defaultdict(Counter)
        for p in pieces:
            for i, b in enumerate(p):
                for k in range(min(i, depth) + 1):
                    self.seen[p[i - k : i]][b] += 1

    def chance(self, before, byte):
        out, excluded = 1.0, set()
        for k in range(min(self.depth, len(before)), -1, -1):
            counts = self.seen.get(before[len(before) - k :])
            if counts is None:
                continue
            left = {b: n for b, n in counts.items() if b not in excluded}
            if not left:
                continue
            total = sum(left.values()) + len(left)
            if byte in left:
                return out * left[byte] / total
            out *= len(left) / total
            excluded |= set(left)
        return out / (256 - len(excluded))

    def bits(self, text):
        return -sum(math.log2(self.chance(text[:i], b)) for i, b in enumerate(text))


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS held_out", "1 AS parts", "'y' AS piece")


def made(language, n, seed):
    rng = random.Random(seed)
    parts = {"aa": ["ka", "to", "mi", "ru"], "bb": ["schl", "ein", "über", "ge"], "cc": ["é", "tion", "eau", "où"]}[language]
    return " ".join("".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(n))


def corpus(n=300):
    return [(k, made("abc"[k % 3] * 2, 30, k), "abc"[k % 3] * 2, "s", 1) for k in range(n)]


@pytest.mark.parametrize("depth", [0, 1, 3, 4])
def test_code_lengths_agree_with_a_plain_coder(depth):
    pieces = [ppm.coded_form(made("aa", 40, k)) for k in range(3)] + [b"abracadabra ", b"a", "ä€ä ".encode()]
    tree, plain = ppm.Tree(pieces, depth), Plain(pieces, depth)
    texts = [b"", b"kato mi ", b"abracadabrabra ", "xyz ä€ü ".encode(), ppm.coded_form(made("cc", 50, 9)), *pieces]
    got = ppm.code_lengths([tree, tree], texts, size=7)
    np.testing.assert_allclose(got[:, 0], [plain.bits(t) for t in texts], rtol=1e-12)
    np.testing.assert_allclose(ppm.code_lengths([tree], texts)[:, 0], got[:, 1], rtol=1e-12)


def test_chances_of_all_bytes_add_up_to_one():
    tree = ppm.Tree([ppm.coded_form(made("bb", 60, 1))], 3)
    for before in (b"", b"s", b"ein", b"ge", "üb".encode(), b"qqq", b"xge"):
        runs = np.concatenate([ppm.runs_of([(0, before, bytes([b]))], 3)[0] for b in range(256)])
        assert np.exp2(-tree.bits(runs)).sum() == pytest.approx(1.0, abs=1e-12)


def test_nothing_learned_codes_bytes_alike():
    assert ppm.code_lengths([ppm.Tree([])], [b"abc"])[0, 0] == 24.0


def test_languages_of_held_out_texts(spark):
    rows = corpus()
    got = {r["doc_id"]: r for r in ppm.predict_languages(table(spark, rows)).collect()}
    import zlib

    for k, _, lang, _, _ in rows:
        assert got[k]["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1)
        assert got[k]["lang_pred"] == lang and 0.5 < got[k]["score"] <= 1
    # what is held out teaches nothing
    odd = [(k, "zzz qqq", "zz", "s", 1) if got[k]["held_out"] else r for (k, *_), r in zip(rows, rows)]
    again = {r["doc_id"]: r for r in ppm.predict_languages(table(spark, odd)).collect()}
    assert "zz" not in {r["lang_pred"] for r in again.values()}
    assert all(again[k] == got[k] for k in got if not got[k]["held_out"])


def test_odd_rows(spark):
    rows = corpus() + [
        (1000, None, "aa", "s", 1), (1001, "", "aa", "s", 1), (1002, "12 .. \n %", "aa", "s", 1), (1003, "€ … ！", "bb", "s", 1),
        (1004, "你", "cc", "s", 1), (1005, made("cc", 200_000, 7), None, None, None), (2**60 + 1, "KATO MIRU", "aa", "s", 1),
        (None, "kato miru", "aa", "s", 1), (2**60 + 3, "kato", None, "s", 1), (7, "schlein", "bb", "s", 1), (7, "schlein", "bb", "s", 1),
        (1006, "kato", "", "s", 1),
    ]
    got = ppm.predict_languages(table(spark, rows).coalesce(1), size=100_000).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert [by_id[k]["lang_pred"] for k in (1000, 1001, 1002, 1003)] == ["und"] * 4
    assert by_id[1000]["score"] == 0 and by_id[1000]["bits_per_byte"] is None
    assert by_id[1004]["lang_pred"] in ("", "aa", "bb", "cc") and by_id[1005]["lang_pred"] == "cc"
    assert by_id[2**60 + 1]["lang_pred"] == "aa" and by_id[2**60 + 3]["lang_pred"] == "aa"
    assert by_id[None]["held_out"] is False and by_id[None]["lang_pred"] == "aa"
    assert sum(r["doc_id"] == 7 for r in got) == 3


def test_tables_that_teach_nothing(spark):
    assert ppm.predict_languages(table(spark, [])).collect() == []
    rows = [(1, "kato", None, "s", 1), (2, None, "aa", "s", 1)]
    assert [r["lang_pred"] for r in ppm.predict_languages(table(spark, rows)).collect()] == ["und", "und"]
    tie = table(spark, [(k, "kato", "ab"[k % 2], "s", 1) for k in range(40)])
    trees = ppm.learn_languages(tie, pieces=2)
    assert list(trees) == ["a", "b"]  # one piece each
    got = ppm.predict_languages(tie, trees).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("a", 0.5)}
    assert len(ppm.learn_languages(tie, pieces=1)) == 1


def test_the_sample_is_bounded_and_whole_texts_are_drawn_from(spark):
    rows = [(k, f"{k} " + made("aa", 500, k), "aa" if k % 10 else "bb", "s", 1) for k in range(200)]
    rows += [(500 + k, "one text many times " * 10, "aa", "s", 1) for k in range(300)]
    found = ppm.training_pieces(table(spark, rows), pieces=60, piece=100).collect()
    assert len(found) == 60 and {sum(r["lang"] == x for r in found) for x in ("aa", "bb")} == {30}
    assert max(len(r["piece"]) for r in found) <= 100
    starts = {t[:100] for _, t, *_ in rows}
    assert sum(r["piece"] in starts for r in found) < 30  # not only the texts' beginnings
    assert len(ppm.training_pieces(table(spark, rows), pieces=1).collect()) == 1


def test_query_on_given_documents(spark, sf):
    from voltide.llm.common import table as read

    docs = read(spark, sf, "documents")
    got = QUERIES["op11_ppm_language"](spark, sf)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    right = {r["doc_id"]: r["lang"] for r in docs.collect()}
    out = [r for r in got.collect() if r["held_out"]]
    assert sum(r["lang_pred"] == right[r["doc_id"]] for r in out) >= 0.95 * len(out) > 0


def test_extra_columns(spark):
    df = plain_docs(spark, [(1, "kato"), (2, "miru")], extra=True)
    assert {r["lang_pred"] for r in ppm.predict_languages(df).collect()} == {"en"}
