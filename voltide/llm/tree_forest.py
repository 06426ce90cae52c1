"""Embedding near-duplicates by a forest of random-projection trees.

Each tree splits vectors by random directions again and again; a vector close to
the threshold goes to both sides, so a near pair is parted only if it lies wide
across it. Pairs are compared within leaves, by cosine in double precision, and
the links found are joined into components.

Trees have two parts. A label of more than ``GROUP`` classes is first split into cells that
one task holds, by thresholds that are medians of a sample of about ``SAMPLE`` vectors; vectors
are sent to the cells of one such tree, compared, and the files of that shuffle are freed before
the next tree. Within a cell a forest of ``TREES`` trees is grown from all its vectors, where
a copy is a number only, down to leaves of ``LEAF`` vectors or to where a split costs more pairs
than it saves, so a dense cluster is compared in full. Every vector goes through all trees.

Equal vectors of a label are one class with a count, and a cell gives each class
the number of its links there and at most one tie, never a list of pairs. A pair
that shares several cells is counted in the first of them, and there in the first leaf. Cells
above ``GROUP`` classes are compared in pairs of chunks, each in its own task.

Cases: a null vector, an all-zero one, one with null or non-finite components, and
any vector with a null label links with nothing: no links, its own component, kept.
Vectors of different lengths never link. A null id takes part; the smallest id is
taken among those that are not null. Repeated rows are links of each other. Other
columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.llm.common import as_text, freed_shuffles, materialize, shuffle_parts, with_type
from voltide.llm.components import components, forest

LEAST_COSINE = 0.93
#: Trees within a cell, and trees of cells.
TREES, CELL_TREES = 4, 3
#: Vectors that a leaf should hold at most.
LEAF = 2048
#: About so many sampled vectors fit the thresholds between cells.
SAMPLE = 16_384
#: Sampled vectors below which a node is not split.
FEW = 32
#: Half width of the overlap, in units of the largest distance of a linked pair
#: over the square root of the dimension (the spread of its projection).
OVERLAP = 0.5
#: Classes of a label that one task compares, and the share of them that a cell aims at.
GROUP, FILLED = 100_000, 0.7
#: A split must leave at most this share of the pairs; so many directions are tried.
PAIRS_LEFT, TRIES = 0.9, 3
ROWS = 512


def _halves(along: np.ndarray, margin: float) -> tuple[float, np.ndarray, np.ndarray] | None:
    """Median and who goes to either side, or None where the overlap makes the split a loss."""
    middle = float(np.median(along))
    low, high = along <= middle + margin, along >= middle - margin
    one, two = np.count_nonzero(low), np.count_nonzero(high)
    return None if one * one + two * two > PAIRS_LEFT * len(along) ** 2 else (middle, low, high)


@dataclass
class Tree:
    """Node k has children ``left[k]`` and ``right[k]``; a leaf has -1."""

    direction: list[np.ndarray] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)

    def add(self) -> int:
        self.direction.append(np.zeros(0))
        self.threshold.append(0.0)
        self.left.append(-1)
        self.right.append(-1)
        return len(self.left) - 1

    def grow(self, sample: np.ndarray, small: int, margin: float, rng, depth: int = 0) -> int:
        node = self.add()
        if len(sample) <= small or depth >= 40:
            return node
        for _ in range(TRIES):
            direction = rng.standard_normal(sample.shape[1])
            direction /= np.linalg.norm(direction)
            if split := _halves(sample @ direction, margin):
                self.direction[node], (self.threshold[node], low, high) = direction, split
                self.left[node] = self.grow(sample[low], small, margin, rng, depth + 1)
                self.right[node] = self.grow(sample[high], small, margin, rng, depth + 1)
                break
        return node

    def leaves(self, vectors: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
        """``(row, leaf)`` of every leaf a vector reaches."""
        rows, found = [], []
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, at = todo.pop()
            if self.left[node] < 0:
                rows.append(at)
                found.append(np.full(len(at), node))
                continue
            along = vectors[at] @ self.direction[node] - self.threshold[node]
            todo.append((self.left[node], at[along <= margin]))
            todo.append((self.right[node], at[along >= -margin]))
        return np.concatenate(rows), np.concatenate(found)


def margin_of(dimension: int, least: float, overlap: float) -> float:
    return overlap * math.sqrt(max(0.0, 2 - 2 * least)) / math.sqrt(dimension)


def grow_cells(sample: np.ndarray, small: int, margin: float, trees: int = CELL_TREES, seed: int = 1) -> list[Tree]:
    """Trees for unit vectors, with at most about ``small`` sampled ones in a cell."""
    out = []
    for no in range(trees):
        tree = Tree()
        tree.grow(sample, max(FEW, small), margin, np.random.default_rng(seed * 1000 + no))
        out.append(tree)
    return out


def forest_leaves(
    x: np.ndarray, leaf: int, margin: float, trees: int = TREES, seed: int = 2
) -> tuple[list[np.ndarray], np.ndarray]:
    """The rows in each leaf of a forest over the unit vectors ``x``, and the first leaf of each
    row in each tree; nodes of a level share a direction."""
    out: list[np.ndarray] = []
    first = np.zeros((len(x), trees if len(x) > leaf else 1), np.int32)
    for no in range(first.shape[1]):
        begun = len(out)
        rng = np.random.default_rng(seed * 1000 + no)
        along: list[np.ndarray] = []
        todo = [(np.arange(len(x)), 0, 0)]
        while todo:
            at, level, failed = todo.pop()
            if len(at) <= leaf or failed == TRIES:
                out.append(at)
                continue
            while len(along) <= level:
                direction = rng.standard_normal(x.shape[1])
                along.append(x @ (direction / np.linalg.norm(direction)).astype(x.dtype))
            split = _halves(along[level][at], margin)
            if split:
                todo += [(at[split[1]], level + 1, 0), (at[split[2]], level + 1, 0)]
            else:
                todo.append((at, level + 1, failed + 1))
        for k in range(len(out) - 1, begun - 1, -1):
            first[out[k], no] = k
    return out, first


def _units(data: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors of stored ones of one length."""
    x = np.frombuffer(b"".join(data), kind).reshape(len(data), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares stay in range
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _kind(vectors: DataFrame) -> str:
    """How components are stored: in the width they come in."""
    return "<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"


def _stored(vectors: list, kind: str) -> list[bytes | None]:
    """Vectors as bytes; None for those that link with nothing."""
    out: list[bytes | None] = [None] * len(vectors)
    lengths: dict[int, list[int]] = {}
    for i, v in enumerate(vectors):
        if v is not None and len(v):
            lengths.setdefault(len(v), []).append(i)
    for at in lengths.values():
        x = np.array([np.asarray(vectors[i], kind) for i in at])  # a null becomes NaN
        for j in np.flatnonzero(np.isfinite(x).all(axis=1) & x.any(axis=1)):
            out[at[j]] = x[j].tobytes()
    return out


def _read(vectors: DataFrame) -> DataFrame:
    """``vec_id, cls, vec``: class of a label and vector; null where nothing can link."""
    id_type, kind = vectors.schema["vec_id"].dataType.simpleString(), _kind(vectors)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            unnamed = frame["label"].isna()
            vecs = _stored([None if no else v for no, v in zip(unnamed, frame["embedding"])], kind)
            cls = [
                None if v is None else hashlib.blake2b(v, digest_size=16, key=str(label).encode()[:64]).digest()
                for label, v in zip(frame["label"], vecs)
            ]
            yield pd.DataFrame({
                "vec_id": frame["vec_id"].to_numpy(), "label": frame["label"], "cls": cls, "vec": vecs,
            })

    read_rows = vectors.select(as_text("vec_id"), F.col("label").cast("string").alias("label"), "embedding").mapInPandas(
        read, "vec_id string, label string, cls binary, vec binary"
    )
    return with_type(read_rows, "vec_id", id_type).withColumn("node", F.xxhash64("label", "cls"))


def _cells(classes: DataFrame, least: float, sample: int, group: int, kind: str) -> dict[str, tuple[float, list[Tree]]]:
    """Margin and trees of cells for each space of more than ``group`` classes; the driver holds the sample."""
    sizes = materialize(classes.groupBy("space").agg(F.count("*").alias("n")), "spaces")
    spaces = {r["space"]: r["n"] for r in sizes.where(f"n > {group}").collect()}
    if not spaces:
        return {}
    total, low = sizes.agg(F.sum("n")).first()[0], -(2**63)
    drawn = classes.where(F.col("space").isin(list(spaces))) if len(spaces) <= 1000 else classes
    if total > sample:  # hashes are even
        drawn = drawn.where(F.col("node") < F.lit(low + int(2**64 * (sample / total))))
    found: dict[str, list[bytes]] = {}
    for r in sorted(drawn.select("node", "space", "vec").collect()):
        found.setdefault(r["space"], []).append(bytes(r["vec"]))
    out = {}
    for space, n in sorted(spaces.items()):
        whole = Tree()
        whole.add()
        out[space] = (0.0, [whole])
        if space in found:
            units = _units(found[space], kind)
            margin = margin_of(units.shape[1], least, OVERLAP)
            grown = grow_cells(units, int(FILLED * group * len(units) / n), margin)
            # trees that cannot split would all compare the same
            out[space] = (margin, [tree for tree in grown if len(tree.left) > 1] or [whole])
    return out


def _route(
    classes: DataFrame, least: float, trees: int, group: int, sample: int, kind: str, cells: dict | None = None
) -> DataFrame:
    """``node, space, many, vec, leaves``: the cells that a class reaches in the first ``trees`` trees,
    -1 where a space is not split. ``cells``: the trees, where they are known."""
    if cells is None:
        cells = _cells(classes, least, sample, group, kind)
    held = classes.sparkSession.sparkContext.broadcast(cells)  # bound by the sample

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            lists = np.empty(len(frame), object)
            lists[:] = [np.full(1, -1)] * len(frame)
            for space, at in frame.groupby("space", sort=False).indices.items():
                if space not in held.value:
                    continue
                margin, grown = held.value[space]
                x = _units(frame["vec"].iloc[at].tolist(), kind)
                reached = [tree.leaves(x, margin) for tree in grown[:trees]]
                row = np.concatenate([rows for rows, _ in reached])
                cell = np.concatenate([(no << 32) + leaves for no, (_, leaves) in enumerate(reached)])
                order = np.lexsort((cell, row))
                ends = np.cumsum(np.bincount(row, minlength=len(at)))
                lists[at] = np.array([*np.split(cell[order], ends[:-1]), None], object)[:-1]
            frame["leaves"] = lists
            yield frame

    return classes.select("node", "space", "many", "vec").mapInPandas(
        route, "node long, space string, many long, vec binary, leaves array<long>"
    )


def _pairs(x: np.ndarray, least: float, leaf: int, margin: float, trees: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``x`` that link, each pair once: in the first leaf that has both."""
    single = x.astype(np.float32)
    doubt = 1.2e-7 * (x.shape[1] + 8)  # what single precision may be off by
    leaves, first = forest_leaves(single, leaf, margin, trees)
    bits = np.zeros((len(x), -(-len(leaves) // 64)), np.uint64)
    for no, at in enumerate(leaves):
        part = single[at]
        for a in range(0, len(at), ROWS):
            cosines = (part[a : a + ROWS] @ part[a:].T).ravel()
            found = np.flatnonzero(cosines >= least - doubt)
            i, j = np.divmod(found, len(at) - a)
            found, i, j = (v[i < j] for v in (found, i, j))
            for b in range(0, len(found), 20_000):
                p, q, value = at[i[b : b + 20_000] + a], at[j[b : b + 20_000] + a], cosines[found[b : b + 20_000]]
                # most pairs that were seen share the first leaf of a tree
                for column in first.T if no else ():
                    one = column[p]
                    new = (one != column[q]) | (one >= no)
                    p, q, value = p[new], q[new], value[new]
                if no:
                    new = ~(bits[p, : no // 64 + 1] & bits[q, : no // 64 + 1]).any(axis=1)
                    p, q, value = p[new], q[new], value[new]
                close = np.flatnonzero(value < least + doubt)
                keep = np.ones(len(p), bool)
                keep[close] = np.einsum("ij,ij->i", x[p[close]], x[q[close]]) >= least
                yield p[keep], q[keep]
        bits[at, no // 64] |= np.uint64(1 << no % 64)


def _links_of(group: pd.DataFrame, least: float, leaf: int, trees: int, kind: str) -> pd.DataFrame:
    """For one cell (or two chunks of it): links of each class and ties between them."""
    cell, across = int(group["cell"].iloc[0]), group["one"].iloc[0] != group["two"].iloc[0]
    x = _units(group["vec"].tolist(), kind)
    node, many, mine = (group[c].to_numpy() for c in ("node", "many", "mine"))
    row = np.repeat(np.arange(len(group)), [len(c) for c in group["leaves"]])
    before = np.concatenate(group["leaves"].tolist())
    row, before = row[before < cell], before[before < cell]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    earlier = np.full((len(group), place.max(initial=-1) + 1), -1, np.int64)
    earlier[row, place] = before
    links, ties = np.zeros(len(group), np.int64), []
    for p, q in _pairs(x, least, leaf, margin_of(x.shape[1], least, OVERLAP), trees):
        if across:
            p, q = p[mine[p] != mine[q]], q[mine[p] != mine[q]]
        if earlier.shape[1]:
            one, two = earlier[p], earlier[q]
            first = ~((one[:, :, None] == two[:, None, :]) & (one >= 0)[:, :, None]).any(axis=(1, 2))
            p, q = p[first], q[first]
        np.add.at(links, p, many[q])
        np.add.at(links, q, many[p])
        if len(p):
            ties.append(forest(np.stack([node[p], node[q]], axis=1)))
    tied = forest(np.concatenate(ties)) if ties else np.zeros((0, 2), np.int64)
    return pd.DataFrame({
        "node": np.r_[node[links > 0], tied[:, 0]],
        "links": np.r_[links[links > 0], np.zeros(len(tied), np.int64)],
        "tie": pd.array([None] * int((links > 0).sum()) + tied[:, 1].tolist(), "Int64"),
    })


def _large_cells(routed: DataFrame, group: int) -> DataFrame | None:
    """``space, cell, chunks`` of the cells that hold more than ``group`` classes, if any do."""
    counts = (
        routed.select("space", F.explode("leaves").alias("cell"))
        .groupBy("space", "cell").agg(F.count("*").alias("n")).where(f"n > {group}")
    )
    large = materialize(
        counts.select("space", "cell", F.expr(f"cast(ceil(2.0D * n / {group}) as int)").alias("chunks")), "large-cells"
    )
    return None if large.isEmpty() else large


def _links_by(
    routed: DataFrame, large: DataFrame | None, no: int, least: float, trees: int, leaf: int, kind: str
) -> DataFrame:
    """``node, links, tie``: what the cells of tree ``no`` find and those of earlier trees do not."""
    placed = routed.withColumn("cell", F.explode(F.expr(f"filter(leaves, c -> greatest(shiftright(c, 32), 0) = {no})")))
    if large is None:
        dealt = placed.select("*", *[F.lit(0).alias(c) for c in ("mine", "one", "two")])
    else:
        dealt = (
            placed.join(large, ["space", "cell"], "left")
            .withColumn("mine", F.expr("coalesce(cast(pmod(node, chunks) as int), 0)"))
            .withColumn("other", F.explode(F.expr("sequence(0, coalesce(chunks, 1) - 1)")))
            .withColumns({"one": F.least("mine", "other"), "two": F.greatest("mine", "other")})
            .drop("chunks", "other")
        )
    keys = ["space", "cell", "one", "two"]

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for frame in filter(len, frames):
            new = (frame[keys] != frame[keys].shift()).any(axis=1).to_numpy()
            new[0] = not held or (frame[keys].iloc[0] != held[0][keys].iloc[0]).any()
            starts = [*np.flatnonzero(new), len(frame)]
            if starts[0]:
                held.append(frame.iloc[: starts[0]])
            for a, b in zip(starts, starts[1:]):
                if held:
                    yield _links_of(pd.concat(held, ignore_index=True), least, leaf, trees, kind)
                held = [frame.iloc[a:b]]
        if held:
            yield _links_of(pd.concat(held, ignore_index=True), least, leaf, trees, kind)

    return (
        dealt.repartition(shuffle_parts(routed.sparkSession), *keys).sortWithinPartitions(*keys)
        .mapInPandas(compare, "node long, links long, tie long")
    )


def near_vectors(
    vectors: DataFrame, least: float = LEAST_COSINE, trees: int = TREES, leaf: int = LEAF,
    sample: int = SAMPLE, group: int = GROUP,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    spark = vectors.sparkSession
    kind = _kind(vectors)
    # vectors are read twice rather than stored beside their classes
    rows = materialize(_read(vectors).select("vec_id", F.expr("if(vec IS NULL, NULL, node)").alias("node")), "rows")
    classes = (
        _read(vectors).where("vec IS NOT NULL").groupBy("node")
        .agg(
            F.first("vec").alias("vec"), F.first("label").alias("label"),
            F.count("*").alias("many"), F.min("vec_id").alias("first_id"),
        )
        .withColumn("space", F.concat_ws(":", F.length("vec").cast("string"), "label")).drop("label")
    )
    with freed_shuffles(spark):
        classes = materialize(classes, "classes")
        cells = _cells(classes, least, sample, group, kind)

        def routed(some: DataFrame, number: int) -> DataFrame:
            return _route(some, least, number, group, sample, kind, cells)

        large = _large_cells(routed(classes, CELL_TREES), group) if cells else None
        found = materialize(_links_by(routed(classes, 1), large, 0, least, trees, leaf, kind), "links")
        if cells:
            split = spark.createDataFrame([(space,) for space in cells], "space string")
            again = classes.join(F.broadcast(split), "space", "left_semi")  # a row for ``group`` classes at most
            for no in range(1, CELL_TREES):
                more = _links_by(routed(again, no + 1), large, no, least, trees, leaf, kind)
                found = found.unionByName(materialize(more, "links"))
    ties = found.where("tie IS NOT NULL").select(F.col("node").alias("a"), F.col("tie").alias("b"))
    roots = components(ties).select(F.col("node").alias("tied"), "root")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    rooted = (
        classes.select("node", "many", "first_id")
        .join(links, "node", "left")
        .join(roots, F.col("node") == F.col("tied"), "left")
        .select(
            "node", "first_id", F.coalesce("root", "node").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"),
        )
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    answer = rooted.join(smallest, "root").select("node", "n_links", "component_id")
    linkable = rows.where("node IS NOT NULL").join(answer, "node").select(
        "vec_id", "n_links", "component_id"
    )
    alone = rows.where("node IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linkable.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
