"""Quality rules and URL filter against SQL and by hand."""

import collections

import duckdb
import numpy as np
import pytest

from tests.compare import connect, differences
from tests.llm.helpers import by_id, docs
from voltide.llm import divergence, url_filter
from voltide.llm.queries import ORACLES, QUERIES

ENGLISH = "The house of the old man and the sea is a place that it was good for on a day to rest in peace. "


@pytest.mark.parametrize("name", ["op4_url_bloom", "op5_distribution_divergence"])
def test_query_agrees_with_sql(spark, sf, name):
    assert differences(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) == []


def figures(text):
    words = [w.decode() for w in (text or "").encode().split()]
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {
        k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)
    }
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(covered),
    )


def test_base_figures_and_edge_cases(spark):
    repeat = " ".join(f"a{k % 9}" for k in range(40))
    texts = [
        None, "", " \n\t ", "one", ENGLISH * 4, repeat, "x\n\nx\n \nx y\nx", "é ü#*|", "w " * 200,
        " ".join(f"b{k}" for k in range(30)) + " " + " ".join(f"b{k}" for k in range(10)),
    ]
    rows = [*enumerate(texts), (None, ENGLISH), (4, texts[4])]
    got = divergence.judge_documents(docs(spark, rows, extra=True))
    assert got.count() == len(rows)
    found = by_id(got)
    for i, text in enumerate(texts):
        r, want = found[i], figures(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
    assert divergence.judge_documents(docs(spark, [])).collect() == []


def test_divergence_rejects_noise_and_keeps_prose(spark):
    rng = np.random.default_rng(0)
    words = ["the", "of", "and", "to", "in", "house", "river", "people", "a", "is", "water", "that", "stone"]
    own = [f"{a}{b}er" for a in ("man", "wat", "sto", "hou", "riv") for b in ("in", "al", "on", "es")]
    prose = " ".join(rng.choice(words[:5] if rng.random() < 0.25 else own) for _ in range(150)) + ". The end."
    noise = " ".join(w + rng.choice(["###", "$$$", "%%%", "|"]) for w in rng.choice(words, 150))
    shout = " ".join(w.upper() + "!!" for w in rng.choice(words, 150))
    listed = " | ".join(f"{w}{k}" for k, w in enumerate(rng.choice(["item", "thing", "price"], 120)))
    rows = [(1, prose), (2, noise), (3, shout), (4, listed)]
    df = docs(spark, rows, extra=True)
    assert {i: r["kept"] for i, r in by_id(divergence.judge_documents(df)).items()} == {
        1: True, 2: False, 3: False, 4: False,
    }
    kept = divergence.keep_documents(df)
    assert kept.columns == df.columns
    assert [r["doc_id"] for r in kept.collect()] == [1]


def test_distance_is_the_same_in_sql():
    shares, reference = [0.5, 0.2, 0.3, 0.0], [0.4, 0.3, 0.2, 0.1]
    p, q = np.array(shares), np.array(reference)
    m = (p + q) / 2
    part = lambda x: sum(a * np.log2(a / b) for a, b in zip(x, m) if a > 0)
    want = np.sqrt((part(p) + part(q)) / 2)
    names = [f"CAST({x} AS DOUBLE)" for x in shares]
    got = duckdb.sql(f"SELECT {divergence.distance_sql(names, reference)}").fetchall()[0][0]
    assert abs(got - want) < 1e-12
    assert 0.8 < divergence.word_reference("en")["the"] / divergence.word_reference("fr")["de"] < 1.2


URLS = [
    (1, "https://a.org/x"), (2, "http://example.org/es/1"), (3, "http://m.example.org/en/123"),
    (4, "http://m.example.org/en/2"), (5, "http://X.COM/fr/1?q#z"), (6, "http://x.com/de/9"), (7, "http://x.com/es/"),
    (8, "no scheme"), (9, None), (10, "https://org"), (11, "https://badexample.org/es/"), (12, "https://org/"),
    (13, "http://listed.net/a/?utm_source=q&b=2&a=1#f"), (14, "https://www.listed.net:443/a?a=1&b=2"),
    (15, "http://listed.net/b"), (16, "x://://y/"), (None, "http://x.com/de/9"), (6, "http://x.com/de/9"),
]
RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def test_rules_and_listed_urls(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").selectExpr("*", "'x' AS host", "'y' AS verdict")
    listed = spark.createDataFrame([("https://listed.net/a?b=2&a=1",), (None,), ("http://listed.net/c",)], "url string")
    entries = url_filter.rule_entries(spark, RULES).unionByName(url_filter.url_entries(listed))
    got = url_filter.judge_urls(pages, entries)
    assert got.count() == len(URLS)
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in got.collect() if r["page_id"]}
    assert found == {
        1: ("org/", "allow"), 2: ("example.org/es/", "block"), 3: ("example.org/en/1", "block"),
        4: ("org/", "allow"), 5: ("com/fr/", "allow"), 6: ("com/de/", "block"), 7: (None, "allow"),
        8: (None, "allow"), 9: (None, "allow"), 10: (None, "allow"), 11: ("org/", "allow"), 12: ("org/", "allow"),
        13: (None, "block"), 14: (None, "block"), 15: (None, "allow"), 16: (None, "allow"),
    }
    parts = {r["page_id"]: (r["host"], r["path"]) for r in got.collect()}
    assert parts[5] == ("x.com", "/fr/1") and parts[8] == ("", "") and parts[9] == ("", "") and parts[10] == ("org", "")


def test_filter_has_no_false_negatives_and_few_false_hits(spark):
    keys = spark.range(20_000).selectExpr("concat('url:', id) AS key")
    blocks = url_filter.build_filter(keys)
    both = spark.range(40_000).selectExpr("concat('url:', id) AS key").selectExpr(
        "key", "xxhash64(key) AS one", "xxhash64(key, 1) AS two"
    ).toPandas()
    hit = url_filter.maybe_listed(blocks, both["one"].to_numpy(), both["two"].to_numpy())
    assert hit[:20_000].all()
    assert hit[20_000:].mean() < 0.02


def test_empty_pages_and_empty_list(spark):
    none = url_filter.rule_entries(spark, RULES).where("false")
    pages = spark.createDataFrame(URLS[:3], "page_id long, url string")
    assert {r["verdict"] for r in url_filter.judge_urls(pages, none).collect()} == {"allow"}
    assert url_filter.judge_urls(pages.where("false"), url_filter.rule_entries(spark, RULES)).collect() == []
