"""Quality rules by distribution divergence, in DataFrame functions only.

A document's histogram of character classes and its histogram of common words are
held against language references by Jensen-Shannon distance (the square root of
the divergence to base 2). A document is rejected when its characters are far from
ordinary prose, or its common words are far from every language. Short documents
are no fair sample of either, so each rule has a least number of words.

Cases: a null text counts as empty: it has no words and fails the base rule. Every
row is judged by itself, so repeated rows and null ids keep their places. Other
columns, whatever their names, are left alone by :func:`keep_documents` and ignored
by :func:`judge_documents`. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Share of each class of characters in ordinary prose.
PROSE = {
    "letter": 0.795, "upper": 0.02, "digit": 0.005, "space": 0.155, "stop": 0.02, "mark": 0.002,
    "symbol": 0.003,
}
#: The most common words of each language, most frequent first.
COMMON = {
    "en": "the of and to a in is that it for was on".split(),
    "fr": "de la le et les en des un du une que est".split(),
    "de": "der die und in den von zu das sich mit des auf".split(),
    "es": "de la que el en y los las se del un por".split(),
}
#: Share of all words that the listed ones have; within it they fall as 1 / rank.
COMMON_SHARE = 0.25

#: Rules: (least number of words, largest distance).
CHARACTER_RULES = ((20, 0.30), (50, 0.18))
WORD_RULE = (60, 0.33)
BASE_WORDS = 20
WINDOW = 8

SPACE_RUN = r"[\x20\x09-\x0D]+"
#: Patterns of the classes; letters are what no other class has.
CLASSES = {
    "upper": r"\p{Lu}+",
    "digit": r"[0-9]+",
    "stop": r"[-.,;:'\x22()@^~_=+/{}\[\]]+",
    "mark": r"[!?]+",
    "symbol": r"[#*$%&|<>]+",
}

BASE = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
)


def common_words() -> list[str]:
    return sorted({w for words in COMMON.values() for w in words})


def word_reference(language: str) -> dict[str, float]:
    words = COMMON[language]
    whole = sum(1 / r for r in range(1, len(words) + 1))
    return {w: COMMON_SHARE / r / whole for r, w in enumerate(words, 1)}


def distance_sql(shares: list[str], reference: list[float]) -> str:
    """Jensen-Shannon distance, as an expression that Spark SQL and DuckDB both take."""
    terms = []
    for p, q in zip(shares, reference):
        q_text = f"CAST({q!r} AS DOUBLE)"
        middle = f"(({p} + {q_text}) / 2)"
        terms.append(f"CASE WHEN {p} > 0 THEN {p} * log2({p} / {middle}) ELSE 0 END")
        terms.append(f"{q_text} * log2({q_text} / {middle})")
    return f"sqrt(greatest((({' + '.join(terms)}) / 2), CAST(0 AS DOUBLE)))"


def word_name(word: str) -> str:
    return "w_" + word


def character_distance_sql() -> str:
    return distance_sql([f"p_{c}" for c in PROSE], list(PROSE.values()))


def word_distance_sql() -> str:
    """Distance to the nearest language; words outside its list are one class."""
    each = []
    for language in COMMON:
        reference = word_reference(language)
        shares = [f"({word_name(w)} / words)" for w in reference]
        rest = f"(1 - ({' + '.join(word_name(w) for w in reference)}) / words)"
        each.append(distance_sql([*shares, rest], [*reference.values(), 1 - sum(reference.values())]))
    return f"least({', '.join(each)})"


def verdict_sql() -> str:
    """True for what the method rejects; ``n_words`` and both distances are columns."""
    rules = [f"(n_words >= {n} AND character_distance > {d})" for n, d in CHARACTER_RULES]
    rules.append(f"(n_words >= {WORD_RULE[0]} AND word_distance > {WORD_RULE[1]})")
    return " OR ".join(rules)


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def _same(word: str):
    return lambda w: w == F.lit(word)


def _repeat_words(words: Column) -> Column:
    """Words in windows that stand in the text at least twice."""

    def of_windows(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            _bind(
                F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
                of_sorted,
            )
        )

    def of_sorted(ordered: Column) -> Column:
        # neighbours with one hash are the same window; the ends have one neighbour
        repeated = F.filter(
            ordered,
            lambda x, k: F.coalesce(F.get(ordered, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(ordered, k + 1)["h"] == x["h"], F.lit(False)),
        )
        places = F.sort_array(F.transform(repeated, lambda x: x["i"]))
        return _bind(places, of_places)

    def of_places(places: Column) -> Column:
        return F.aggregate(
            F.transform(
                places,
                lambda p, k: F.coalesce(F.least(F.lit(WINDOW), F.get(places, k + 1) - p), F.lit(WINDOW)),
            ),
            F.lit(0), lambda total, n: total + n,
        )

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    windows = _bind(
        hashed,
        lambda h: F.transform(
            F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)),
            lambda i: F.xxhash64(F.slice(h, i, F.lit(WINDOW))),
        ),
    )
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(
        _bind(windows, of_windows)
    )


def _measured(rows: DataFrame) -> DataFrame:
    """All figures of ``rows`` (columns ``row_`` and ``t_``)."""
    split = rows.withColumn("words_", F.filter(F.split("t_", SPACE_RUN), lambda w: w != ""))
    lines = F.filter(F.split("t_", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    listed = common_words()
    counted = split.select(
        "row_",
        F.size("words_").cast("long").alias("n_words"),
        F.length("t_").alias("chars"),
        F.length(F.array_join("words_", "")).cast("long").alias("word_chars"),
        _bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words_")).cast("long").alias("n_repeat_words"),
        *[
            (F.length("t_") - F.length(F.regexp_replace("t_", pattern, ""))).alias(f"c_{name}")
            for name, pattern in CLASSES.items()
        ],
        F.filter("words_", lambda w: w.isin(listed)).alias("common"),
    )
    shares = counted.select(
        "row_", "n_words", "word_chars", "n_dup_lines", "n_repeat_words",
        F.col("c_symbol").cast("long").alias("n_symbols"),
        *[(F.col(f"c_{c}") / F.expr("greatest(chars, 1)")).alias(f"p_{c}") for c in CLASSES],
        F.expr("(chars - word_chars) / greatest(chars, 1)").alias("p_space"),
        F.expr("cast(greatest(n_words, 1) as double)").alias("words"),
        *[F.size(F.filter("common", _same(x))).alias(word_name(x)) for x in listed],
    ).withColumn("p_letter", 1 - sum((F.col(f"p_{c}") for c in CLASSES), F.col("p_space")))
    judged = shares.select(
        "row_", *BASE[:5],
        F.expr(character_distance_sql()).alias("character_distance"),
        F.expr(word_distance_sql()).alias("word_distance"),
    )
    failed = f"n_words < {BASE_WORDS} OR 100 * n_repeat_words > 30 * n_words"
    return judged.withColumn("base_failed", F.expr(failed)).withColumn(
        "kept", F.expr(f"NOT base_failed AND NOT ({verdict_sql()})")
    )


def judge_documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base figures, both distances and the verdict of every row."""
    rows = docs.select(
        F.struct("doc_id").alias("row_"), F.coalesce(F.col("text"), F.lit("")).alias("t_")
    )
    return _measured(rows).select(
        F.col("row_.doc_id").alias("doc_id"), *BASE, "character_distance", "word_distance"
    )


def keep_documents(docs: DataFrame) -> DataFrame:
    """The rows that are kept, with the columns they came with."""
    rows = docs.select(
        F.struct("*").alias("row_"), F.coalesce(F.col("text"), F.lit("")).alias("t_")
    )
    # a filter would be pushed below the figures and work them out again and again
    kept = F.when(F.col("kept"), F.array("row_"))
    return _measured(rows).select(F.explode(kept).alias("row_")).select("row_.*")
