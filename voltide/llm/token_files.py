"""Token files: an id array with Elias-Fano coded document boundaries.

A file is a folder of blocks in ascending ``doc_id`` order. A block holds the
ids of its documents one after the other, 16 or 32 bits each, and two monotone
lists, the document ids and the ends of the documents, in Elias-Fano form: about
``2 + log2(range / count)`` bits an entry. ``select`` finds the end of a document
through sampled counts, without a table of 64-bit offsets. Blocks are written by
Spark as binary rows of Parquet, so a lost task leaves no part of a file.

Cases: a null text counts as empty, so its document is its end id alone. Ids are whole
numbers; text that is none fails the job. Null ids
come first and are kept as null. Rows with one id stand side by side, in the
order of their ids' bytes. Other columns are ignored. An empty table gives an
empty folder, read as an empty table.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.llm.bpe import WordBpe, batches, loaded
from voltide.llm.common import as_text, shuffle_parts, text_or_empty

END_ID = 2
MAGIC = b"TOKB"
#: Ids of a block, about; a document is never split.
BLOCK_IDS = 2_000_000
#: Every so many set bits the select structure keeps a position.
SAMPLE = 256

#: ``before`` counts the ids of the same bucket in earlier blocks.
FOLDER = "bucket int, block int, before long, n_docs long, n_ids long, payload binary"


class EliasFano:
    """A non-decreasing list of integers from 0, with access by position."""

    HEADER = struct.Struct("<QBQQQ")

    def __init__(self, count: int, low_bits: int, low: np.ndarray, high: np.ndarray, sample: np.ndarray):
        self.count, self.low_bits = count, low_bits
        self.low, self.high, self.sample = low, high, sample

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = values & np.uint64((1 << low_bits) - 1)
        bits = ((low[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
        high[at] = 1
        return cls(
            n, low_bits, np.packbits(bits.ravel(), bitorder="little"),
            np.packbits(high, bitorder="little"), at[::SAMPLE].astype(np.uint32),
        )

    def to_bytes(self) -> bytes:
        return self.HEADER.pack(
            self.count, self.low_bits, len(self.low), len(self.high), len(self.sample)
        ) + self.low.tobytes() + self.high.tobytes() + self.sample.tobytes()

    @classmethod
    def from_bytes(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        n, low_bits, low, high, sample = cls.HEADER.unpack_from(data, at)
        at += cls.HEADER.size
        parts = []
        for size, kind in ((low, np.uint8), (high, np.uint8), (sample, "<u4")):
            parts.append(np.frombuffer(data, kind, size, at))
            at += parts[-1].nbytes
        return cls(n, low_bits, *parts), at

    def select(self, i: int) -> int:
        """Entry ``i``: from the nearest sampled position, then through the bits."""
        start = int(self.sample[i // SAMPLE])
        left, byte = i % SAMPLE, start // 8
        bits = np.unpackbits(self.high[byte : byte + 8], bitorder="little")
        bits[: start % 8] = 0
        ahead = 8
        while int(bits.sum()) <= left:
            bits = np.concatenate(
                [bits, np.unpackbits(self.high[byte + ahead : byte + 2 * ahead], bitorder="little")]
            )
            ahead *= 2
        at = byte * 8 + int(np.flatnonzero(bits)[left])
        return ((at - i) << self.low_bits) | self._low(i)

    def _low(self, i: int) -> int:
        if not self.low_bits:
            return 0
        start = i * self.low_bits
        word = int.from_bytes(self.low[start // 8 : (start + self.low_bits + 7) // 8].tobytes(), "little")
        return (word >> (start % 8)) & ((1 << self.low_bits) - 1)

    def all(self) -> np.ndarray:
        """Every entry, in one pass."""
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.count]
        out = (at - np.arange(self.count)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(self.low, bitorder="little")[: self.count * self.low_bits]
            weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
            out |= bits.reshape(self.count, self.low_bits).astype(np.uint64) @ weights
        return out.astype(np.int64)


def write_block(doc_ids: list[int | None], ids: list[bytes], wide: bool) -> bytes:
    """One block; ``ids`` are little-endian, ``doc_ids`` ascend with nulls first."""
    size = 4 if wide else 2
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    base = int(known[0]) if len(known) else 0
    ends = np.cumsum([len(i) // size for i in ids]) if ids else np.zeros(0)
    head = struct.pack("<4sBQq", MAGIC, size, len(doc_ids) - len(known), base)
    return head + EliasFano.of(known - base).to_bytes() + EliasFano.of(ends).to_bytes() + b"".join(ids)


class Block:
    """A block that was read back."""

    def __init__(self, payload: bytes):
        data = memoryview(payload)
        magic, size, self.nulls, self.base = struct.unpack_from("<4sBQq", data)
        if magic != MAGIC:
            raise ValueError("not a token block")
        at = struct.calcsize("<4sBQq")
        self.names, at = EliasFano.from_bytes(data, at)
        self.ends, at = EliasFano.from_bytes(data, at)
        self.ids = np.frombuffer(data, f"<u{size}", (len(data) - at) // size, at)

    def __len__(self) -> int:
        return self.ends.count

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + [int(d) + self.base for d in self.names.all()]

    def document(self, i: int) -> np.ndarray:
        """Ids of document ``i``; its bounds come from the select structure."""
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int = END_ID) -> None:
    """Encode every text and write the blocks to ``folder``."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    parts = shuffle_parts(spark)
    # ranges of ids: their bounds are a number for each task
    cuts = rows.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.25 / parts)
    bounds = np.array(sorted({min(max(int(c), -(2**63)), 2**63 - 1) for c in cuts}), np.int64)

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = loaded(WordBpe, path)
        for frame in frames:
            texts, names = frame["text"].tolist(), frame["doc_id"]
            known = names.notna().to_numpy()
            bucket = np.full(len(names), -1, np.int32)
            bucket[known] = np.searchsorted(bounds, names[known].map(int).to_numpy(np.int64), side="right")
            for a, b in batches(texts):
                yield pd.DataFrame({
                    "bucket": bucket[a:b], "doc_id": names.iloc[a:b],
                    "ids": [
                        np.append(ids, end_id).astype(bpe.dtype).tobytes()
                        for ids in bpe.ids_of(texts[a:b])
                    ],
                })

    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wide = loaded(WordBpe, path).dtype.itemsize == 4
        names: list[int | None] = []
        held: list[bytes] = []
        bucket, block, before, size = None, 0, 0, 0

        def made() -> pd.DataFrame:
            return pd.DataFrame({
                "bucket": [bucket], "block": [block], "before": [before], "n_docs": [len(held)],
                "n_ids": [size], "payload": [write_block(names, held, wide)],
            })

        for frame in frames:
            for b, doc_id, ids in zip(frame["bucket"], frame["doc_id"], frame["ids"]):
                if held and (b != bucket or size >= BLOCK_IDS):
                    yield made()
                    block, before = block + 1, before + size
                    names, held, size = [], [], 0
                if b != bucket:
                    bucket, block, before = b, 0, 0
                names.append(None if doc_id is None else int(doc_id))
                held.append(ids)
                size += len(ids) // (4 if wide else 2)
        if held:
            yield made()

    (
        rows.select(as_text("doc_id"), "text").mapInPandas(encode, "bucket int, doc_id string, ids binary")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", F.col("doc_id").cast("long"), "ids")
        .mapInPandas(blocks, FOLDER)
        .write.parquet(folder)
    )


def read_tokens(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32[, ids]`` of every document of a folder."""
    stored = spark.read.schema(FOLDER).parquet(folder)
    # a number for each task that wrote
    totals = stored.groupBy("bucket").agg(F.sum("n_ids").alias("n")).collect()
    first, total = {}, 0
    for r in sorted(totals, key=lambda r: r["bucket"]):
        first[r["bucket"]] = total
        total += r["n"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else "")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for bucket, before, payload in zip(frame["bucket"], frame["before"], frame["payload"]):
                block = Block(payload)
                found = [block.document(i) for i in range(len(block))]
                n = np.array([len(f) for f in found], np.int64)
                start = first[bucket] + before + np.cumsum(n) - n
                out = pd.DataFrame({
                    "doc_id": pd.array(block.doc_ids(), "Int64"), "start": start, "n_tokens": n,
                    "ids_crc32": [zlib.crc32(f.astype("<u4")) for f in found],
                })
                if ids:
                    out["ids"] = [f.astype(np.int32) for f in found]
                yield out

    return stored.mapInPandas(read, schema)
