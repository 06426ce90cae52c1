"""URL filter: a blocked Bloom filter in front of an exact hash join.

Listed entries are rules (a host with its subdomains and the start of a path) and
canonical URLs. Each page has a few keys: its canonical URL, and its host's
suffixes with those starts of its path that are as long as a listed rule's. Keys
are looked up in the filter, one 512-bit block each; possible hits go to a join on
the key itself, which removes the false ones. The filter's size has a fixed
bound; a longer list only lets more false hits through to the join.

Cases: a null URL, or one without ``://``, has an empty host and path, fits no rule
and is no listed URL, so it is allowed. Repeated URLs and repeated rows get equal
verdicts. A repeated entry counts once; between a blocking and an allowing entry
for one key, the blocking one holds. Other columns are ignored. An empty list allows
all, an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS_AN_ENTRY = 16
#: Bound of the filter: so many blocks of 64 bytes (16 MB).
MOST_BLOCKS = 1 << 18
WORDS = 8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that only track visitors.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$"


def host(url: str = "url") -> Column:
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path(url: str = "url") -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: str = "url") -> Column:
    """Host without ``www.`` and usual port, path without last slash, sorted query
    without tracking; null where there is no host."""
    query = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_join(
        F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(TRACKING))), "&"
    )
    name = F.regexp_replace(F.regexp_replace(host(url), r"^www\.", ""), r":(80|443)$", "")
    whole = F.concat(
        name, F.regexp_replace(path(url), r"/+$", ""),
        F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""),
    )
    return F.when(host(url) != "", whole)


def rule_entries(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Entries for ``(verdict, rule)`` pairs; a rule is a host and the start of a path."""
    return spark.createDataFrame(
        [("rule:" + rule, rule, verdict) for verdict, rule in rules],
        "key string, rule string, verdict string",
    )


def url_entries(urls: DataFrame, verdict: str = "block") -> DataFrame:
    """Entries for the canonical forms of column ``url``."""
    return (
        urls.select(F.concat(F.lit("url:"), canonical()).alias("key"))
        .where("key IS NOT NULL")
        .distinct()
        .select("key", F.lit(None).cast("string").alias("rule"), F.lit(verdict).alias("verdict"))
    )


def _keys(lengths: list[int]) -> Column:
    """The keys under which a page may be listed."""
    labels = F.split("host", r"\.")
    suffixes = F.when(F.col("host") != "", F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )).otherwise(F.array().cast("array<string>"))
    starts = [
        F.transform(
            F.when(F.length("path") >= n, suffixes).otherwise(F.array().cast("array<string>")),
            _joined(F.substring("path", 1, n)),
        )
        for n in lengths
    ]
    whole = F.when(F.col("canonical").isNotNull(), F.array(F.concat(F.lit("url:"), "canonical")))
    return F.concat(*starts, F.coalesce(whole, F.array().cast("array<string>")))


def _joined(start: Column):
    return lambda suffix: F.concat(F.lit("rule:"), suffix, start)


def _two_hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(key, F.lit(1))


def build_filter(entries: DataFrame) -> np.ndarray:
    """Blocks of the filter: a row of eight 64-bit words each.

    Bits are joined on the executors; at most ``MOST_BLOCKS`` rows reach the driver.
    """
    wanted = max(1, entries.count() * BITS_AN_ENTRY // (64 * WORDS))
    blocks = min(MOST_BLOCKS, 1 << (wanted - 1).bit_length())
    one, two = _two_hashes(F.col("key"))
    bits = [
        F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(two, {6 * i}) & 63 as int)))").alias(f"w{i}")
        for i in range(WORDS)
    ]
    rows = (
        entries.select(F.pmod(one, F.lit(blocks)).alias("block"), two.alias("two"))
        .groupBy("block").agg(*bits).collect()
    )
    out = np.zeros((blocks, WORDS), np.int64)
    for r in rows:
        out[r["block"]] = r[1:]
    return out.view(np.uint64)


def maybe_listed(blocks: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """True where both hashes of a key may belong to a listed one; never false for those."""
    block = blocks[np.mod(one, len(blocks))]
    shifts = (two.view(np.uint64)[:, None] >> (np.arange(WORDS, dtype=np.uint64) * np.uint64(6))) & np.uint64(63)
    return ((block >> shifts) & np.uint64(1)).all(axis=1)


def judge_urls(pages: DataFrame, entries: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    The longest rule that fits decides; without one, a listed URL's verdict;
    without that, ``default``.
    """
    spark = pages.sparkSession
    lengths = [
        r[0] for r in entries.where("rule IS NOT NULL")
        .select(F.length("rule") - F.instr("rule", "/") + 1).distinct().collect()
    ]
    blocks = spark.sparkContext.broadcast(build_filter(entries))
    rows = pages.select(
        "page_id", "url", host().alias("host"), path().alias("path"), canonical().alias("canonical")
    )
    keyed = (
        rows.select("url", _keys(sorted(lengths)).alias("keys"))
        .select("url", F.explode("keys").alias("key"))
        .select("url", "key", *[h.alias(n) for h, n in zip(_two_hashes(F.col("key")), ("one", "two"))])
    )

    def possible(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                hit = maybe_listed(blocks.value, frame["one"].to_numpy(), frame["two"].to_numpy())
                yield frame.loc[hit, ["url", "key"]]

    once = entries.groupBy("key").agg(F.max("rule").alias("rule"), F.max("verdict").alias("verdict"))
    found = (
        keyed.mapInPandas(possible, "url string, key string").distinct().join(once, "key")
        .groupBy("url")
        .agg(
            F.max(F.when(F.col("rule").isNotNull(), F.struct(F.length("rule"), "rule", "verdict"))).alias("best"),
            F.max(F.when(F.col("rule").isNull(), F.col("verdict"))).alias("listed"),
        )
    )
    return rows.join(found, "url", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", "listed", F.lit(default)).alias("verdict"),
    )
