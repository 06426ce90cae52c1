"""How far the sources of each language lie apart in their words.

Terms are counted for every (language, source) group. A group's smoothed share of a
term, in billionths, is compared with those of the other sources and of the whole
language by the triangular divergence ``(p - q)^2 / (p + q)``, summed over terms in
whole numbers.

The comparison is dealt out as a cube: groups of a language are cut into blocks, its
terms into blocks by hash, and a task owns the cells (group block, group block, term
block). A slice (group block, term block) is sent to every cell that needs it, a cell
adds up the divergences of its pairs over its terms, and the sums of the cells are
added along the term axis. A cell holds two dense arrays of ``GROUP_BLOCK`` by about
``TERM_BLOCK`` numbers, however many sources, terms or documents there are.

Cases: a null text, language or source counts as ''. Repeated rows, also of one id,
are documents each. A group without terms has every count 0; a language without kept
terms has divergences of 0 and no term rows. A lone source has no pairs. Equal values
are ranked by the name's UTF-8 bytes. An empty table gives an empty table. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltide.llm.common import materialize

#: Documents of a language that a kept term is in, at least.
LEAST_DOCUMENTS = 10
#: Ranks of the terms that set a group apart.
TERM_RANKS = 10
#: Shares are counted in parts of this; ``SMOOTH`` occurrences are added to each term.
UNIT, SMOOTH = 1_000_000_000, 2
GROUP_BLOCK, TERM_BLOCK = 32, 2048
#: Different terms that a task counts before it sends them on.
HELD_TERMS = 400_000

#: Letters of terms, A-Z in lower case; all other ASCII bytes separate terms.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and characters beyond ASCII, A-Z in lower case."""
    return text.translate(_LETTERS).split()


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Occurrences and documents of each term by group, added up within the task."""
    held: dict[tuple, dict[bytes, list[int]]] = {}
    size = 0

    def sent() -> pd.DataFrame:
        rows = [(*g, t, *n) for g, terms in held.items() for t, n in terms.items()]
        return pd.DataFrame(rows, columns=["lang", "source", "term", "n", "docs"])

    for frame in frames:
        for lang, source, text in zip(frame["lang"], frame["source"], frame["text"]):
            group = held.setdefault((lang, source), {})
            before, seen = len(group), set()
            for term in terms_of(text):
                count = group.get(term)
                if count is None:
                    count = group[term] = [0, 0]
                count[0] += 1
                if term not in seen:
                    seen.add(term)
                    count[1] += 1
            size += len(group) - before
            if size >= HELD_TERMS:
                yield sent()
                held, size = {}, 0
    if size:
        yield sent()


def _share(n, total, kinds):
    """``1 + floor(UNIT * (n + SMOOTH) / (total + SMOOTH * kinds))``, exact."""
    return F.expr(
        f"1 + CAST(({UNIT}BD * (CAST({n} AS DECIMAL(19, 0)) + {SMOOTH})) div"
        f" CAST({total} + {SMOOTH} * {kinds} AS DECIMAL(19, 0)) AS BIGINT)"
    )


def _apart(p: str, q: str):
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def term_counts(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, term, lang_n, by_source``: kept terms with their occurrences in each source."""
    rows = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
    )
    counted = rows.mapInPandas(_counted, "lang string, source string, term binary, n long, docs long")
    grouped = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # one row per source and term by now, so the list is as long as the language has sources
    return (
        grouped.groupBy("lang", "term")
        .agg(
            F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"),
            F.collect_list(F.struct("source", "n")).alias("by_source"),
        )
        .where(F.col("docs") >= least_documents)
        .select("lang", F.col("term").cast("string").alias("term"), "lang_n", "by_source")
    )


def _cell(name: str):
    """The divergences of a cell's pairs of groups, summed over its terms."""

    def partial(key: tuple, slices: pd.DataFrame) -> pd.DataFrame:
        lang, a, b, _ = key
        dense = {}
        for row in slices.itertuples(index=False):
            p = np.repeat(np.asarray(row.rest, np.int64)[:, None], row.terms, axis=1)
            p[np.asarray(row.group, np.int64), np.asarray(row.at, np.int64)] = np.asarray(row.p, np.int64)
            dense[row.block] = list(row.sources), p
        (left, p), (right, q) = dense[a], dense[b]
        out = []
        for i, source in enumerate(left):
            far = ((p[i] - q) ** 2 // (p[i] + q)).sum(axis=1)
            out += [(lang, source, other, int(v)) for j, (other, v) in enumerate(zip(right, far)) if a < b or i < j]
        return pd.DataFrame(out, columns=["lang", "source", "item", name])

    return partial


def audit_sources(
    docs: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    term_ranks: int = TERM_RANKS,
    group_block: int = GROUP_BLOCK,
    term_block: int = TERM_BLOCK,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: for each group its distance to every
    other source of the language (``pair``) and the terms it uses more than the
    language does, the most telling first (``term``)."""
    terms = materialize(term_counts(docs, least_documents), "terms")
    by_source = terms.select("lang", "term", "lang_n", F.explode("by_source").alias("s")).select(
        "lang", "term", "lang_n", "s.source", "s.n"
    )
    # bounded by the languages and sources
    kinds = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("lang_n").alias("lang_total"))
    totals = by_source.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    occurring = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    ).distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = materialize(
        occurring.join(kinds, "lang", "left").join(totals, ["lang", "source"], "left")
        .na.fill(0, ["kinds", "lang_total", "total"])
        .withColumn("place", place)
        .withColumns({
            "block": F.expr(f"place div {group_block}"), "group": F.expr(f"place % {group_block}"),
            "term_blocks": F.expr(f"greatest(1, (kinds + {term_block - 1}) div {term_block})"),
            "rest": F.when(F.col("kinds") > 0, _share("0", "total", "kinds")).otherwise(F.lit(0).cast("long")),
        }),
        "groups",
    )
    langs = groups.groupBy("lang").agg(
        F.first("term_blocks").alias("term_blocks"), F.max("block").alias("last_block")
    )

    # the term axis: blocks by hash, terms numbered within their block
    numbered = terms.join(langs.select("lang", "term_blocks"), "lang").withColumn(
        "term_block", F.pmod(F.xxhash64("term"), F.col("term_blocks"))
    )
    at = F.row_number().over(Window.partitionBy("lang", "term_block").orderBy("term")) - 1
    numbered = numbered.withColumn("at", at)
    axis = materialize(numbered.select("lang", "term_block", "at", "by_source"), "term-axis")
    lengths = axis.groupBy("lang", "term_block").agg(F.count(F.lit(1)).cast("int").alias("terms"))
    term_blocks = (
        langs.select("lang", "last_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("term_blocks") - 1)).alias("term_block"))
        .join(lengths, ["lang", "term_block"], "left").na.fill(0, ["terms"])
    )

    # slices: a group block's shares of a term block; terms a group lacks have its rest
    entries = (
        axis.select("lang", "term_block", "at", F.explode("by_source").alias("s"))
        .select("lang", "term_block", "at", "s.source", "s.n")
        .join(groups.select("lang", "source", "block", "group", "total", "kinds"), ["lang", "source"])
        .withColumn("p", _share("n", "total", "kinds"))
        .groupBy("lang", "block", "term_block")
        .agg(F.collect_list(F.struct("group", "at", "p")).alias("e"))
        .select("lang", "block", "term_block", *[F.col(f"e.{c}").alias(c) for c in ("group", "at", "p")])
    )
    sides = (
        groups.groupBy("lang", "block")
        .agg(F.sort_array(F.collect_list(F.struct("group", "source", "rest"))).alias("e"))
        .select("lang", "block", F.col("e.source").alias("sources"), F.col("e.rest").alias("rest"))
    )
    none = {c: F.coalesce(c, F.array().cast(t)) for c, t in
            (("group", "array<long>"), ("at", "array<int>"), ("p", "array<long>"))}
    slices = (
        sides.join(term_blocks, "lang").join(entries, ["lang", "block", "term_block"], "left").withColumns(none)
    )
    cells = slices.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last_block")))).select(
        "lang", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
        "term_block", "block", "sources", "rest", "terms", "group", "at", "p",
    )
    partial = cells.groupBy("lang", "a", "b", "term_block").applyInPandas(
        _cell("value"), "lang string, source string, item string, value long"
    )
    summed = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = summed.withColumn(
        "ends", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    ).select("lang", "ends.source", "ends.item", "value")

    telling = (
        by_source.join(groups.select("lang", "source", "total", "kinds", "lang_total"), ["lang", "source"])
        .withColumns({"p": _share("n", "total", "kinds"), "q": _share("lang_n", "lang_total", "kinds")})
        .where("p > q")
        .select("lang", "source", F.col("term").alias("item"), _apart("p", "q").alias("value"))
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = telling.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= term_ranks)
    pairs = both.withColumn("rank", F.row_number().over(order))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").unionByName(
        ranked.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    )
