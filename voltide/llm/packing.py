"""Best-fit packing of token pieces by large-item matching.

The plan depends only on how many pieces have each length, so it is made from a
histogram with at most ``capacity`` entries, whatever the number of documents.
Pieces above a third of the capacity go at most two to a sequence: the longest
takes the longest partner that fits. Shorter ones then go, longest first, where
the least room is left. The plan says for each range of ranks within a length
which sequences and places it takes; pieces find theirs by rank.

Cases: a null text counts as empty, so its document is its end id alone. Repeated
rows are packed once each. Null ids are kept. Other columns are ignored. An empty
table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltide.llm.bpe import ByteBpe, batches, loaded
from voltide.llm.common import as_text, materialize, text_or_empty, with_type

CAPACITY = 1024
END_ID = 2


def pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = True
) -> DataFrame:
    """Pieces of at most ``capacity`` ids; only a first piece may be shorter.

    ``doc_id, piece, start, length, ids_crc32, part, rank``, and ``ids`` if wanted.
    ``rank`` counts pieces of one length within the ``part`` that made them.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(as_text("doc_id"), text_or_empty().alias("text"))
    schema = "doc_id string, piece int, start long, length long, ids_crc32 long, part int, rank long"

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe, seen = loaded(ByteBpe, path), Counter()
        part = TaskContext.get().partitionId()
        for frame in frames:
            texts, doc_ids = frame["text"].tolist(), frame["doc_id"].to_numpy()
            for a, b in batches(texts):
                out, owner, kept = [], [], []
                for row, found in enumerate(bpe.ids_of(texts[a:b]), a):
                    whole = np.append(found, end_id).astype("<u4")
                    first = len(whole) % capacity or capacity
                    edges = [0, *range(first, len(whole) + 1, capacity)]
                    for no, (s, e) in enumerate(zip(edges, edges[1:])):
                        n = e - s
                        out.append((no, s, n, zlib.crc32(whole[s:e]), part, seen[n]))
                        seen[n] += 1
                        owner.append(row)
                        if ids:
                            kept.append(whole[s:e].astype(np.int32))
                made = pd.DataFrame(
                    out, columns=["piece", "start", "length", "ids_crc32", "part", "rank"]
                )
                made.insert(0, "doc_id", doc_ids[owner])
                if ids:
                    made["ids"] = kept
                yield made

    made = rows.mapInPandas(cut, schema + (", ids array<int>" if ids else ""))
    return with_type(made, "doc_id", id_type)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Slots ``(length, low, high, each, sequence, offset)`` for a histogram of lengths.

    Pieces of ``length`` with ranks from ``low`` to before ``high`` go ``each`` to
    a sequence, numbered from ``sequence`` on, the first of them at ``offset``.
    """
    left = {n: c for n, c in counts.items() if c}
    taken: Counter = Counter()
    slots: list[tuple[int, int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> runs (first sequence, how many)
    sequences = 0

    def place(length: int, many: int, each: int, sequence: int, offset: int) -> None:
        low = taken[length]
        slots.append((length, low, low + many, each, sequence, offset))
        taken[length] += many
        left[length] -= many

    def leave(gap: int, sequence: int, many: int) -> None:
        if gap and many:
            room.setdefault(gap, []).append((sequence, many))

    third = capacity // 3
    for big in range(capacity, third, -1):
        while left.get(big):
            mate = next(
                (m for m in range(min(big, capacity - big), third, -1) if left.get(m, 0) > (m == big)),
                0,
            )
            if mate == big:
                many = left[big] // 2
                place(big, 2 * many, 2, sequences, 0)
                leave(capacity - 2 * big, sequences, many)
            elif mate:
                many = min(left[big], left[mate])
                place(big, many, 1, sequences, 0)
                place(mate, many, 1, sequences, big)
                leave(capacity - big - mate, sequences, many)
            else:
                many = left[big]
                place(big, many, 1, sequences, 0)
                leave(capacity - big, sequences, many)
            sequences += many
    for small in range(third, 0, -1):
        while left.get(small):
            gap = min((g for g in room if g >= small), default=0)
            if not gap:
                each = capacity // small
                leave(capacity, sequences, -(-left[small] // each))
                sequences += -(-left[small] // each)
                continue
            first, many = room[gap].pop()
            if not room[gap]:
                del room[gap]
            each = min(gap // small, left[small])
            full = min(many, left[small] // each)
            place(small, full * each, each, first, capacity - gap)
            leave(gap - each * small, first, full)
            leave(gap, first + full, many - full)
    return slots


def pack(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id`` and ``offset`` for stored pieces (see :func:`pieces`)."""
    spark = made.sparkSession
    each = made.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = each.select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")
    )
    # at most one row per length up to the capacity
    histogram = made.groupBy("length").agg(F.count("*").alias("n")).collect()
    names = ["length", "low", "high", "each", "sequence", "place"]
    found = np.array(plan({r["length"]: r["n"] for r in histogram}, capacity), np.int64).reshape(-1, len(names))
    # from Arrow, as rows of Python objects would start more Python workers on every executor
    slots = spark.createDataFrame(pa.table(dict(zip(names, found.T.copy()))))
    ranked = made.join(shift, ["length", "part"]).withColumn("of_all", F.col("rank") + F.col("shift"))
    # slots: a few per length, so their number is bound by the capacity
    return (
        ranked.join(F.broadcast(slots), "length")
        .where("of_all >= low AND of_all < high")
        .withColumn("turn", F.col("of_all") - F.col("low"))
        .withColumn("sequence_id", F.col("sequence") + F.expr("turn div each"))
        .withColumn("offset", F.col("place") + (F.col("turn") % F.col("each")) * F.col("length"))
        .drop("turn", "of_all", "shift", "low", "high", "each", "sequence", "place", "part", "rank")
    )


def pack_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = True
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]`` of all pieces."""
    made = materialize(pieces(docs, path, capacity, end_id, ids), "pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return pack(made, capacity).select(*columns, *(["ids"] if ids else []))
