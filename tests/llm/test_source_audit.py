"""Source divergence against a plain version and SQL."""

import random
import re
from collections import Counter

import pytest

from tests.compare import connect, differences
from voltide.llm.queries import ORACLES, QUERIES
from voltide.llm.source_audit import audit_sources, terms_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def plain(rows, least=10, ranks=10):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER)))
            for _, text, lang, source, _ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for _, _, terms in own for t in set(terms))
        kept = sorted(t for t, n in seen.items() if n >= least)
        counts = {s: Counter() for _, s, _ in own}
        for _, s, terms in own:
            counts[s].update(t for t in terms if t in set(kept))

        def shares(count):
            total = sum(count.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 2) // total for t in kept}

        q = shares(sum(counts.values(), Counter()))
        p = {s: shares(c) for s, c in counts.items()}

        def far(a, b, t):
            return (a[t] - b[t]) ** 2 // (a[t] + b[t])

        for s in counts:
            pair = [(sum(far(p[s], p[o], t) for t in kept), o) for o in counts if o != s]
            term = [(far(p[s], q, t), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, len(pair)), ("term", term, ranks)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(found[:most])]
    return sorted(out)


def result(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "'x' AS term", "1 AS n", "'y' AS block", "'z' AS s", "2 AS value", "3 AS rank"
    )


def corpus():
    rng = random.Random(5)
    kinds = ["the", "The", "été", "ÉTÉ", "naïve", "x", "zz", "a b", "日本", "\U0001f600", *[f"w{chr(97 + k)}" for k in range(20)]]
    rows = [
        (k, " 1_".join(rng.choices(kinds, k=rng.randrange(0, 30))), rng.choice(["en", "fr", None]),
         rng.choice(["s1", "s2", "s3", "", None, "é"]), None)
        for k in range(400)
    ]
    rows += [(None, "the the x", "en", "s1", 1)] * 15  # copies of one row
    rows += [(7, None, "en", "silent", 1), (8, "", "de", "s1", 1), (9, None, "de", "s2", 1), (10, "rare", "it", "s1", 1)]
    rows.append((11, "the " * 200_000 + "x" * 100_000, "en", "s2", 1))
    return rows


@pytest.mark.parametrize(("group_block", "term_block"), [(32, 2048), (2, 3), (1, 1)])
def test_agrees_with_a_plain_version(spark, group_block, term_block):
    rows = corpus()
    got = audit_sources(table(spark, rows), group_block=group_block, term_block=term_block)
    assert result(got) == plain(rows)


def test_small_bounds_and_ranks(spark):
    rows = corpus()
    got = audit_sources(table(spark, rows), least_documents=1, term_ranks=3, term_block=4)
    assert result(got) == plain(rows, least=1, ranks=3)


def test_empty_table_and_lone_source(spark):
    assert audit_sources(table(spark, [])).collect() == []
    rows = [(k, "alpha beta", "en", "only", 1) for k in range(20)]
    assert result(audit_sources(table(spark, rows))) == plain(rows) == []


def test_terms():
    assert terms_of("A-b É_ç\x7f日本 x9Y".encode()) == ["a".encode(), b"b", "É".encode(), "ç".encode(), "日本 x".encode(), b"y"]


def test_tasks_send_on_what_they_hold(spark, monkeypatch):
    from voltide.llm import source_audit

    monkeypatch.setattr(source_audit, "HELD_TERMS", 10)
    rows = corpus()
    import pandas as pd

    frame = pd.DataFrame({"lang": [r[2] or "" for r in rows], "source": [r[3] or "" for r in rows],
                          "text": [(r[1] or "").encode() for r in rows]})
    parts = list(source_audit._counted(iter([frame[:200], frame[200:]])))
    assert len(parts) > 3 and max(map(len, parts)) < 200
    whole = pd.concat(parts).groupby(["lang", "source", "term"]).sum()
    want = Counter(t for lang, s, x in frame.itertuples(index=False) for t in terms_of(x))
    assert whole["n"].sum() == sum(want.values())


def test_query_agrees_with_sql(spark, sf):
    assert differences(QUERIES["op13_source_audit"](spark, sf), connect(sf), ORACLES["op13_source_audit"]) == []
