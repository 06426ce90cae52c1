"""Encrypted columns, pseudonyms and audit counts."""

from __future__ import annotations

import secrets
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def encrypt_columns(df: DataFrame, columns: Sequence[str], key: Column) -> DataFrame:
    """AES-GCM of each column's text, as base64. ``key`` has 16, 24 or 32 bytes."""
    return df.withColumns(
        {c: F.base64(F.aes_encrypt(F.col(c).cast("string"), key, F.lit("GCM"))) for c in columns}
    )


def decrypt_columns(df: DataFrame, columns: Sequence[str], key: Column) -> DataFrame:
    return df.withColumns(
        {c: F.aes_decrypt(F.unbase64(c), key, F.lit("GCM")).cast("string") for c in columns}
    )


def new_keys(spark: SparkSession, key_ids: Sequence[str], size: int = 16) -> DataFrame:
    """Fresh random keys, ``key_id, key``; store them where only the readers may look."""
    rows = [(k, bytearray(secrets.token_bytes(size))) for k in key_ids]
    return spark.createDataFrame(rows, "key_id string, key binary")


def encrypt_by_key_id(df: DataFrame, columns: Sequence[str], keys: DataFrame, key_id: str = "key_id") -> DataFrame:
    """Encrypt each row's columns with the key its ``key_id`` names.

    Keys come from a table, so no plan, log or query text shows one, and old rows stay
    readable when new ones get a new key. A row whose key is unknown fails the job, as it
    would be lost or left readable otherwise.
    """
    return _keyed(df, keys, key_id, lambda t, key: encrypt_columns(t, columns, key))


def decrypt_by_key_id(df: DataFrame, columns: Sequence[str], keys: DataFrame, key_id: str = "key_id") -> DataFrame:
    return _keyed(df, keys, key_id, lambda t, key: decrypt_columns(t, columns, key))


def _keyed(df: DataFrame, keys: DataFrame, key_id: str, change) -> DataFrame:
    named = keys.select(F.col("key_id").alias("_key_id"), F.col("key").alias("_key"))
    joined = df.join(named, F.col(f"`{key_id}`") == F.col("_key_id"), "left")
    unknown = F.raise_error(F.concat(F.lit("no key "), F.coalesce(F.col(f"`{key_id}`").cast("string"), F.lit("null"))))
    known = F.when(F.col("_key").isNull(), unknown.cast("binary")).otherwise(F.col("_key"))
    return change(joined, known).select(*[F.col(f"`{c}`") for c in df.columns])


def pseudonymize(df: DataFrame, column: str, salt: str, name: str | None = None) -> DataFrame:
    """Replace a key by its salted SHA-256; the same salt gives the same pseudonym."""
    digest = F.sha2(F.concat(F.lit(salt), F.col(column).cast("string")), 256)
    out = df.withColumn(name or column, digest)
    return out if name is None else out.drop(column)


def audit_counts(events: DataFrame) -> DataFrame:
    """Events per type, status and day."""
    return events.groupBy("event_type", "status", F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("events")
    )
