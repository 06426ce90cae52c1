"""BPE encoding and decoding by tree concatenation.

Long texts are dealt over tasks in parts; a word too long for one part is cut
into halves that are encoded apart. Around each join a window of tokens is
encoded anew and grows until it shares a token with either side; then the joined
list is exactly what the tokenizers library gives for the whole text.

Cases: a null text counts as empty and gives no ids. Rows are independent, so
repeated rows and repeated or null ids give a row each. Other columns of the
input are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.llm.bpe import ByteBpe, batches, loaded
from voltide.llm.common import as_text, shuffle_parts, text_or_empty, with_type

#: Characters of a part; longer texts are dealt over tasks.
PART = 65536

Finish = Callable[[ByteBpe, np.ndarray], tuple]


def _finish_ids(bpe: ByteBpe, ids: np.ndarray) -> tuple:
    return (ids.astype(np.int32),)


def _finish_digest(bpe: ByteBpe, ids: np.ndarray) -> tuple:
    listed = ids.tolist()
    decoded = bpe.text_of(listed)
    return (
        len(listed),
        hashlib.sha256(",".join(map(str, listed)).encode()).hexdigest(),
        hashlib.sha256(decoded.encode()).hexdigest(),
    )


def _over_texts(docs: DataFrame, path: str, finish: Finish, schema: str, part: int) -> DataFrame:
    """One row per document: ``finish`` of its ids; ``schema`` names its columns."""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(as_text("doc_id"), text_or_empty().alias("text"))
    out_schema = f"doc_id string, {schema}"

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = loaded(ByteBpe, path)
        for frame in frames:
            texts = frame["text"].tolist()
            found = [
                finish(bpe, ids) for a, b in batches(texts) for ids in bpe.ids_of(texts[a:b])
            ]
            out = pd.DataFrame(found, columns=names)
            out.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield out

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = loaded(ByteBpe, path)
        for frame in frames:
            for doc_id, text, digest, copies in zip(
                frame["doc_id"], frame["text"], frame["digest"], frame["copies"]
            ):
                parts = bpe.cuts(text, part)
                yield pd.DataFrame({
                    "doc_id": [doc_id] * len(parts), "digest": digest, "copies": copies,
                    "no": range(len(parts)), "run": [r for r, _ in parts],
                    "part": [p for _, p in parts],
                })

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = loaded(ByteBpe, path)
        for frame in frames:
            frame["ids"] = [
                np.array(bpe.part_ids(run, p), "<u4").tobytes()
                for run, p in zip(frame["run"], frame["part"])
            ]
            yield frame.drop(columns="part")

    def join(group: pd.DataFrame) -> pd.DataFrame:
        bpe = loaded(ByteBpe, path)
        group = group.sort_values("no")
        ids = bpe.join([
            (run, np.frombuffer(i, "<u4").tolist()) for run, i in zip(group["run"], group["ids"])
        ])
        out = pd.DataFrame([finish(bpe, ids)], columns=names)
        out.insert(0, "copies", group["copies"].iloc[0])
        out.insert(0, "doc_id", group["doc_id"].iloc[:1].to_numpy())
        return out

    long = F.length("text") > part
    short = rows.where(~long).mapInPandas(whole, out_schema)
    keyed = (
        rows.where(long)
        .groupBy("doc_id", "text")
        .agg(F.count("*").alias("copies"))
        .withColumn("digest", F.sha2("text", 256))
    )
    key = "doc_id string, digest string, copies long, no int, run int"
    parts = keyed.mapInPandas(cut, key + ", part string").repartition(
        shuffle_parts(docs.sparkSession), "doc_id", "digest", "no"
    )
    joined = (
        parts.mapInPandas(encode, key + ", ids binary")
        .groupBy("doc_id", "digest")
        .applyInPandas(join, f"doc_id string, copies long, {schema}")
        .withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
        .drop("copies", "copy")
    )
    return with_type(short.unionByName(joined), "doc_id", id_type)


def encode_documents(docs: DataFrame, path: str, part: int = PART) -> DataFrame:
    """``doc_id, ids array<int>`` of every text."""
    return _over_texts(docs, path, _finish_ids, "ids array<int>", part)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of every list of ids; null ids give null."""
    id_type = encoded.schema["doc_id"].dataType.simpleString()

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = loaded(ByteBpe, path)
        for frame in frames:
            frame["text"] = [
                None if ids is None else bpe.text_of([int(i) for i in ids]) for ids in frame["ids"]
            ]
            yield frame[["doc_id", "text"]]

    decoded = encoded.select(as_text("doc_id"), "ids").mapInPandas(decode, "doc_id string, text string")
    return with_type(decoded, "doc_id", id_type)


def digest_documents(docs: DataFrame, path: str, part: int = PART) -> DataFrame:
    """Encode, then decode: count and digests of ids and of the decoded text."""
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _over_texts(docs, path, _finish_digest, schema, part)
