"""Small tables for the tests."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n: int, seed: int, kinds: int = 4000) -> list[str]:
    """Invented words; different seeds share hardly any run of words."""
    rng = random.Random(seed)
    return ["w" + format(rng.randrange(kinds), "x") for _ in range(n)]


def prose(n: int, seed: int) -> str:
    return " ".join(words(n, seed))


def docs(spark, rows, extra: bool = False):
    """``rows``: (doc_id, text). ``extra`` adds columns with names that operators use."""
    full = [(i, t, "en", "src", len(t) if t is not None else None) for i, t in rows]
    df = spark.createDataFrame(full, DOCS)
    if extra:
        for name in ("ids", "fp", "node", "key", "kept", "words", "part", "start", "chars", "t_", "h"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def by_id(df) -> dict:
    return {r["doc_id"]: r for r in df.collect()}
