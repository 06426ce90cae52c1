"""SimHash near-duplicates, compared through tables of pivot distances.

Two fingerprints that differ in at most ``bits`` places have, for every reference
fingerprint, distances to it that differ by at most ``bits``. Each fingerprint
therefore gets a table row of its distances to many fixed references; a pair
whose largest coordinate difference is above ``bits`` is discarded and only
survivors are compared bit by bit.

Pairs come from groups that share enough of the bits. :func:`block_keys` cuts 64
bits into ``bits + 3`` blocks; a linked pair agrees on three of them, so nothing
is missed. :func:`band_keys` draws bits of a wider fingerprint, for distances too
large for that; what it misses follows from its numbers. Equal fingerprints are
one node, and a group gives at most one link a node: links inside it are followed
from node to node, so a group of thousands of near copies costs little more than
its size. Groups above ``GROUP`` nodes are compared in pairs of chunks, each in its
own task.

Cases: a null text counts as empty; a text without words has fingerprint zero,
linked like any other. Equal rows get equal results. A null id takes part, but the
smallest id is taken among those that are not null. Other columns are ignored.
An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.llm.common import as_text, materialize, shuffle_parts, text_or_empty, with_type, words_of
from voltide.llm.components import components, forest

SHINGLE = 4
BITS = 4
SEED = 42
PIVOTS = 16
#: Blocks that must agree beside those that may differ.
AGREE = 3
#: Nodes of a group that one task compares.
GROUP = 50_000
#: Groups up to this size are compared together, a shift at a time.
SMALL = 48

#: For documents whose sets of five-word shingles have a Jaccard similarity of 0.8
#: or more: bits of 256 differ at a rate of acos(2 J / (1 + J)) / pi, 0.15 at 0.8.
#: 46 bits leave room for chance; 48 draws of 14 bits meet 19 of 20 such pairs at
#: the edge and nearly all closer ones.
SIMILAR_SHINGLE, SIMILAR_WIDTH, SIMILAR_BITS = 5, 4, 46
DRAWS, DRAWN = 48, 14
#: Fingerprints only propose: a tie counts if the sets of shingles are so similar.
SIMILAR = 0.8
#: Shingles of the documents that one task compares exactly.
MOST_SHINGLES = 600_000

Keys = Callable[[np.ndarray], np.ndarray]


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``shingle`` words, or of a shorter text as a whole."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
        starts = [0, *(e + 1 for e in ends[: -shingle])]
        hash_of = xxhash.xxh64_intdigest
        hashes = [hash_of(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :])]
    return np.array(hashes, np.uint64)


def fingerprint(text: str, shingle: int = SHINGLE, width: int = 1) -> np.ndarray:
    """``width`` numbers of 64 bits; a bit is 1 if it is set in over half the hashes."""
    return fold(shingles(text, shingle), width)


def fold(base: np.ndarray, width: int = 1) -> np.ndarray:
    """The fingerprint of shingles."""
    if not len(base):
        return np.zeros(width, np.uint64)
    out = np.empty(width, np.uint64)
    for no in range(width):
        bits = np.unpackbits(
            _stirred(base, no).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        ones = bits.sum(axis=0, dtype=np.int64) * 2 > len(base)
        out[no] = np.packbits(ones, bitorder="little").view("<u8")[0]
    return out


def _stirred(hashes: np.ndarray, no: int) -> np.ndarray:
    """Further hashes from given ones; number 0 leaves them as they are."""
    if not no:
        return hashes
    x = hashes * np.uint64(0x9E3779B97F4A7C15 + 2 * no)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, width: int = 1) -> DataFrame:
    """``doc_id, node, fp``: ``fp`` as bytes; ``node`` names it: itself at width 1, else a hash."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fps = [fingerprint(t, shingle, width) for t in frame["text"]]
            nodes = [f[0] if width == 1 else np.uint64(xxhash.xxh64_intdigest(f.tobytes())) for f in fps]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "node": np.array(nodes, np.uint64).view(np.int64),
                "fp": [f.astype("<u8").tobytes() for f in fps],
            })

    found = docs.select(as_text("doc_id"), text_or_empty().alias("text")).mapInPandas(
        of, "doc_id string, node long, fp binary"
    )
    return with_type(found, "doc_id", id_type)


def references(count: int = PIVOTS, width: int = 1) -> np.ndarray:
    """Fixed reference fingerprints, a row each."""
    return np.random.default_rng(7).integers(0, 2**64, (count, width), dtype=np.uint64)


def distance(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one ^ two).sum(axis=-1, dtype=np.int16)


def pivot_table(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Row i: distances of all fingerprints to reference i."""
    return np.stack([distance(fps, p) for p in pivots])


def near(one: np.ndarray, two: np.ndarray, table_one, table_two, bits: int) -> np.ndarray:
    """Positions where ``one`` and ``two`` differ in at most ``bits`` places; ``two`` may be one row."""
    alive = np.arange(len(one))
    single = len(two) == 1
    for a, b in zip(table_one, table_two):
        alive = alive[np.abs(a[alive] - (b if single else b[alive])) <= bits]
        if not len(alive):
            return alive
    return alive[distance(one[alive], two if single else two[alive]) <= bits]


def _follow(fps: np.ndarray, bits: int, pivots: np.ndarray) -> list[tuple[int, int]]:
    """Positions of links that connect what is connected in one group."""
    links, table, left = [], pivot_table(fps, pivots), np.arange(len(fps))
    while len(left) > 1:
        waiting, left = [left[0]], left[1:]
        while waiting and len(left):
            node = waiting.pop()
            found = near(fps[left], fps[node : node + 1], table[:, left], table[:, node : node + 1], bits)
            if len(found):
                links += [(node, i) for i in left[found]]
                waiting += left[found].tolist()
                left = np.delete(left, found)
    return links


def _links(keys: np.ndarray, nodes: np.ndarray, fps: np.ndarray, bits: int, pivots: np.ndarray) -> np.ndarray:
    """Ties of nodes that are linked within the groups of sorted ``keys``."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    found = [np.zeros((0, 2), np.int64)]
    small = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
    k, n, f = keys[small], nodes[small], fps[small]
    if len(k):
        table = pivot_table(f, pivots)
        for shift in range(1, SMALL):
            same = np.flatnonzero(k[shift:] == k[:-shift])
            if not len(same):
                break
            ahead = same + shift
            hit = same[near(f[same], f[ahead], table[:, same], table[:, ahead], bits)] if len(same) > 1 else (
                same[distance(f[same], f[ahead]) <= bits]
            )
            found.append(np.stack([n[hit], n[hit + shift]], axis=1))
    for at in np.flatnonzero(sizes > SMALL):
        own = slice(starts[at], starts[at] + sizes[at])
        pairs = _follow(fps[own], bits, pivots)
        if pairs:
            found.append(nodes[own][np.array(pairs)])
    pairs = np.concatenate(found)
    return forest(pairs) if len(pairs) else pairs


def block_keys(bits: int = BITS) -> Keys:
    """A key for each choice of blocks of 64 bits that may be the ones that agree."""
    count = bits + AGREE
    edges = [64 * i // count for i in range(count + 1)]

    def keys(fps: np.ndarray) -> np.ndarray:
        blocks = [
            (fps[:, 0] >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
            for low, high in zip(edges, edges[1:])
        ]
        out = []
        for no, chosen in enumerate(combinations(range(count), AGREE)):
            key = np.full(len(fps), no, np.uint64)
            for c in chosen:
                key = (key << np.uint64(edges[c + 1] - edges[c])) | blocks[c]
            out.append(key.view(np.int64))
        return np.stack(out, axis=1)

    return keys


def band_keys(draws: int = DRAWS, drawn: int = DRAWN, width: int = SIMILAR_WIDTH) -> Keys:
    """A key for each of ``draws`` random draws of ``drawn`` bits."""
    rng = np.random.default_rng(11)
    chosen = [rng.choice(64 * width, drawn, replace=False) for _ in range(draws)]
    weights = 1 << np.arange(drawn)

    def keys(fps: np.ndarray) -> np.ndarray:
        bits = np.unpackbits(fps.astype("<u8").view(np.uint8), axis=1, bitorder="little")
        return np.stack([
            (no << drawn) + bits[:, c].astype(np.int64) @ weights for no, c in enumerate(chosen)
        ], axis=1)

    return keys


def linked(
    nodes: DataFrame, keys_of: Keys, bits: int = BITS, width: int = 1, group: int = GROUP, pivots: int = PIVOTS
) -> DataFrame:
    """``a, b``: ties of the ``node`` s whose ``fp`` s differ in at most ``bits`` places.

    What links connect stays connected, but not every pair is listed.
    """
    spark = nodes.sparkSession
    refs = references(pivots, width)

    def unpack(fps) -> np.ndarray:
        return np.frombuffer(b"".join(fps), "<u8").reshape(-1, width)

    def key(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 2000):
                part = frame.iloc[at : at + 2000]
                keys = keys_of(unpack(part["fp"]))
                times = keys.shape[1]
                yield pd.DataFrame({
                    "key": keys.ravel(), "node": np.repeat(part["node"].to_numpy(), times),
                    "fp": np.repeat(part["fp"].to_numpy(), times),
                })

    keyed = nodes.select("node", "fp").mapInPandas(key, "key long, node long, fp binary")

    def made(keys, members, fps) -> pd.DataFrame:
        tree = _links(keys, members, unpack(fps), bits, refs)
        return pd.DataFrame({"a": tree[:, 0], "b": pd.array(tree[:, 1], "Int64"), "size": 0})

    def told(key, size) -> pd.DataFrame:
        return pd.DataFrame({"a": [key], "b": pd.array([None], "Int64"), "size": [size]})

    def compare(frames: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
        """Ties of whole groups; of a group above ``most`` only key and size, with ``b`` null."""
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object))
        too_large, size = None, 0
        for frame in chain(frames, [None]):
            if frame is not None and len(frame):
                new = [frame[c].to_numpy() for c in ("key", "node", "fp")]
                if too_large is not None:
                    more = int(np.count_nonzero(new[0] == too_large))
                    size, new = size + more, [x[more:] for x in new]
                    if not len(new[0]):
                        continue
                    yield told(too_large, size)
                    too_large = None
                held = tuple(np.concatenate([x, y]) for x, y in zip(held, new))
            elif frame is not None:
                continue
            end = len(held[0])
            if frame is not None and end:
                end = int(np.searchsorted(held[0], held[0][-1]))  # the last group may go on
            if end:
                yield made(*(x[:end] for x in held))
                held = tuple(x[end:] for x in held)
            if len(held[0]) > most:
                too_large, size = held[0][0], len(held[0])
                held = tuple(x[:0] for x in held)
        if too_large is not None:
            yield told(too_large, size)

    def over(rows: DataFrame, most: int) -> DataFrame:
        return (
            rows.repartition(shuffle_parts(spark), "key").sortWithinPartitions("key")
            .mapInPandas(lambda frames: compare(frames, most), "a long, b long, size long")
        )

    found = materialize(over(keyed, group), "near")
    ties = found.where("b IS NOT NULL").select("a", "b")
    large = found.where("b IS NULL").select(
        F.col("a").alias("key"), F.expr(f"cast(ceil(2.0D * size / {group}) as int)").alias("chunks")
    )
    if large.isEmpty():
        return ties
    meets = (
        keyed.join(large, "key")
        .withColumn("mine", F.expr("cast(pmod(xxhash64(node), chunks) as int)"))
        .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
        .select(
            "node", "fp",
            F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"),
        )
    )
    return ties.unionByName(over(meets, 2**62).select("a", "b"))


def _classes(found: DataFrame, ties: DataFrame) -> DataFrame:
    """``node, component_id, group`` for stored fingerprints and the ties between them."""
    nodes = found.groupBy("node").agg(F.min("doc_id").alias("first_id"))
    roots = components(ties).withColumnRenamed("node", "tied")
    rooted = nodes.join(roots, F.col("node") == F.col("tied"), "left").select(
        "node", "first_id", F.coalesce("root", "node").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(smallest, "root").select("node", "component_id", F.col("root").alias("group"))


def _nodes(found: DataFrame) -> DataFrame:
    return found.groupBy("node").agg(F.min("fp").alias("fp"))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, group: int = GROUP
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row; 64 bits, every link found."""
    found = materialize(fingerprints(docs, shingle), "fingerprints")
    classes = _classes(found, linked(_nodes(found), block_keys(bits), bits, 1, group))
    return found.join(classes, "node").select(
        "doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _set_of(base: np.ndarray) -> tuple[np.ndarray, int]:
    """The set of shingles and a hash that names it."""
    own = np.unique(base)
    return own, np.uint64(xxhash.xxh64_intdigest(own.tobytes(), SEED)).astype(np.int64)


def set_fingerprints(docs: DataFrame, shingle: int, width: int) -> DataFrame:
    """``doc_id, text_hash, node, fp``: ``node`` names the set of shingles."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, fps = [], []
            for text in batch["text"]:  # one text and its shingles are held at a time
                base = shingles(text.as_py(), shingle)
                nodes.append(int(_set_of(base)[1]))
                fps.append(fold(base, width).astype("<u8").tobytes())
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "text_hash": batch["text_hash"],
                "node": pa.array(nodes, pa.int64()), "fp": pa.array(fps, pa.binary()),
            })

    found = docs.select(as_text("doc_id"), text_or_empty().alias("text"), text_hash().alias("text_hash")).mapInArrow(
        of, "doc_id string, text_hash long, node long, fp binary"
    )
    return with_type(found, "doc_id", id_type)


def text_hash():
    """Tells the texts of rows with one id apart."""
    return F.xxhash64(text_or_empty())


def similar(nodes: np.ndarray, sets: list[np.ndarray], least: float = SIMILAR) -> np.ndarray:
    """Ties that connect what sets with a Jaccard similarity of ``least`` or more connect."""
    sizes = np.array([len(x) for x in sets])
    order = np.argsort(sizes, kind="stable")
    sizes, nodes = sizes[order], nodes[order]
    codes = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)[1]
    starts = np.r_[0, np.cumsum(sizes)]
    mark = np.zeros(int(codes.max()) + 1 if len(codes) else 1, np.int32)
    left, links = np.ones(len(nodes), bool), []
    for first in range(len(nodes)):
        waiting = [first] if left[first] else []
        left[first] = False
        while waiting:
            node = waiting.pop()
            # sets that are similar enough have sizes within this range
            low = int(np.searchsorted(sizes, least * sizes[node] - 1e-6))
            high = int(np.searchsorted(sizes, sizes[node] / least + 1e-6, "right"))
            there = low + np.flatnonzero(left[low:high])
            if not len(there) or not sizes[node]:
                continue
            mine = codes[starts[node] : starts[node + 1]]
            mark[mine] = 1
            # a running sum, so that sets that are tied already may lie in between
            total = np.r_[0, np.cumsum(mark[codes[starts[low] : starts[high]]])]
            mark[mine] = 0
            both = total[starts[there + 1] - starts[low]] - total[starts[there] - starts[low]]
            found = there[both >= least * (sizes[node] + sizes[there] - both) - 1e-9]
            links += [(nodes[node], nodes[i]) for i in found]
            left[found] = False
            waiting += found.tolist()
    return np.array(links, np.int64).reshape(-1, 2)


def verified(
    docs: DataFrame, found: DataFrame, ties: DataFrame, shingle: int = SIMILAR_SHINGLE,
    least: float = SIMILAR, most: int = MOST_SHINGLES,
) -> DataFrame:
    """``a, b``: ties between nodes whose sets of shingles are similar enough.

    All sets that ``ties`` connect are compared with each other, so a node whose tie
    fails is tried with all its other candidates. More than ``most`` shingles are
    compared in pairs of chunks, each pair in its own task.
    """
    roots = materialize(components(ties), "proposed")
    tied = found.join(roots, "node").select("doc_id").distinct()

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 500):
                made = [_set_of(shingles(t, shingle)) for t in frame["text"].iloc[at : at + 500]]
                yield pd.DataFrame({
                    "node": np.array([n for _, n in made], np.int64), "size": [len(x) for x, _ in made],
                    "set": [x.astype("<u8").tobytes() for x, _ in made],
                })

    texts = docs.select("doc_id", text_or_empty().alias("text")).join(tied, "doc_id", "left_semi").select("text")
    sets = texts.mapInPandas(of, "node long, size long, set binary").dropDuplicates(["node"])
    sets = materialize(sets.join(roots, "node"), "shingle-sets")
    chunks = sets.groupBy("root").agg(F.expr(f"cast(ceil(2.0D * sum(size) / {most}) as int)").alias("chunks"))
    meets = (
        sets.join(chunks, "root")
        .withColumn("chunks", F.expr("if(chunks <= 2, 1, chunks)"))
        .withColumn("mine", F.expr("cast(pmod(xxhash64(node), chunks) as int)"))
        .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
        .select(
            "node", "set",
            F.xxhash64("root", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"),
        )
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        pairs = similar(frame["node"].to_numpy(), [np.frombuffer(x, "<u8") for x in frame["set"]], least)
        return pd.DataFrame(pairs, columns=["a", "b"])

    return meets.groupBy("key").applyInPandas(compare, "a long, b long")


def drop_near_duplicates(
    docs: DataFrame, shingle: int = SIMILAR_SHINGLE, bits: int = SIMILAR_BITS, width: int = SIMILAR_WIDTH,
    draws: int = DRAWS, drawn: int = DRAWN, group: int = GROUP, least: float = SIMILAR, most: int = MOST_SHINGLES,
) -> DataFrame:
    """The row with the smallest id of each group of similar documents, columns as they came.

    Fingerprints propose pairs; those count whose sets of shingles have a Jaccard
    similarity of ``least`` or more. Rows that share an id count as documents of
    their own: of equal ones one stays. Rows without an id stay.
    """
    named = docs.where("doc_id IS NOT NULL")
    found = materialize(set_fingerprints(named, shingle, width), "fingerprints")
    proposed = linked(_nodes(found), band_keys(draws, drawn, width), bits, width, group)
    ties = verified(named, found, proposed, shingle, least, most)
    # of the rows with a group's smallest id, those of one of its texts; of equal rows one
    keep = (
        found.join(_classes(found, ties), "node").where("doc_id = component_id")
        .groupBy("doc_id", "group").agg(F.min("text_hash").alias("text_hash"))
        .select("doc_id", "text_hash").distinct()
    )
    held = named.select("doc_id", text_hash().alias("text_hash"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = held.join(keep, ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"]).select("row.*")
    return kept.unionByName(docs.where("doc_id IS NULL"))
