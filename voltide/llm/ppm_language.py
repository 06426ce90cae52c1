"""Language of a text by prediction by partial matching.

Every language has a tree of byte contexts up to ``DEPTH`` bytes with the counts of
the bytes that followed. A byte is coded in its longest known context; if that never
saw it, an escape is coded and the next shorter context asked, without the bytes that
the longer one has excluded. The chance of an escape is the number of different bytes
over that number plus all occurrences (method C); below the empty context all bytes
left are alike. So code lengths are exact: the chances of all bytes add up to one. The
language whose frozen counts code the text shortest is the prediction, its share of
the chances of all languages the score.

Texts are coded as lower-case words parted by single spaces; other ASCII characters
count as spaces, all others as they are. The trees are learned from a sample of at
most ``PIECES`` pieces of ``PIECE`` characters, shared evenly among the languages and
drawn by hash from the whole texts of all training documents; should there be more
languages than pieces, those with the most text are learned. Prediction covers every
text from its first to its last byte.

Cases: a null text, or one without a letter, is ``und`` with score 0, as is every
text if nothing was learned. Training rows with a null language are left out. A null
id is not held out. Equal code lengths give the first language by its UTF-8 bytes.
Repeated rows are learned from and predicted each. Other columns are ignored. An
empty table gives an empty table.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltide.llm.common import materialize

DEPTH = 4
#: Bound of the training sample: pieces of all languages together, characters of one.
PIECES, PIECE = 4096, 1024
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
#: Bytes that are scored at once.
SLICE = 2_000_000

_WORD_BYTES = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def coded_form(text: str) -> bytes:
    """Lower-case words with a space after each."""
    words = text.lower().encode().translate(_WORD_BYTES).split()
    return b" ".join(words) + b" " if words else b""


def runs_of(segments: list[tuple[int, bytes, bytes]], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all bytes of ``(owner, bytes before, bytes)``: the ``depth`` bytes before, the
    latest one highest, then the byte itself; the owner; the known bytes before it."""
    buffer = b"".join(bytes(depth) + before[-depth:].rjust(depth, b"\0") + body for _, before, body in segments)
    raw = np.frombuffer(bytes(depth) + buffer, np.uint8).astype(np.uint64)
    n = len(raw) - depth
    runs = raw[depth:].copy()
    for back in range(1, depth + 1):
        runs |= raw[depth - back : depth - back + n] << np.uint64(8 * (depth + 1 - back))
    sizes = np.array([2 * depth + len(body) for _, _, body in segments])
    owner = np.repeat([o for o, _, _ in segments], sizes)
    at = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes) - 2 * depth
    body = at >= 0
    known = at + np.repeat([min(depth, len(before)) for _, before, _ in segments], sizes)
    return runs[body], owner[body], np.minimum(known[body], depth)


def _found(names: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of wanted values in sorted names, and whether they are there."""
    if not len(names):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
    return at, names[at] == wanted


class Contexts:
    """The contexts of one length: ``names``, and the bytes seen in them.

    ``total`` occurrences of ``kinds`` different bytes; ``covered`` occurrences that
    the next shorter context has of these bytes.
    """

    def __init__(self, nodes: np.ndarray, counts: np.ndarray, shorter: Contexts | None):
        self.nodes, self.counts = nodes, counts.astype(np.float64)
        self.names, own = np.unique(nodes >> np.uint64(8), return_inverse=True)
        self.total = np.bincount(own, self.counts, len(self.names))
        self.kinds = np.bincount(own, minlength=len(self.names)).astype(np.float64)
        self.covered = np.zeros(len(self.names))
        if shorter is not None:
            up = ((nodes >> np.uint64(16)) << np.uint64(8)) | (nodes & np.uint64(255))
            at, _ = _found(shorter.nodes, up)
            self.covered = np.bincount(own, shorter.counts[at], len(self.names))


class Tree:
    """The frozen byte contexts of a language."""

    def __init__(self, pieces: list[bytes], depth: int = DEPTH):
        self.depth = depth
        runs, _, known = runs_of([(0, b"", p) for p in pieces], depth) if pieces else (np.zeros(0, np.uint64),) * 3
        self.levels: list[Contexts] = []
        for level in range(depth + 1):
            whole = runs[known >= level]
            names, counts = np.unique(self.node(whole, level), return_counts=True)
            self.levels.append(Contexts(names, counts, self.levels[-1] if level else None))

    def context(self, runs: np.ndarray, level: int) -> np.ndarray:
        return runs >> np.uint64(8 * (self.depth + 1 - level)) if level else np.zeros(len(runs), np.uint64)

    def node(self, runs: np.ndarray, level: int) -> np.ndarray:
        return (self.context(runs, level) << np.uint64(8)) | (runs & np.uint64(255))

    def bits(self, runs: np.ndarray) -> np.ndarray:
        """The code length of each run's last byte after the bytes before it."""
        out = np.zeros(len(runs))
        left = np.arange(len(runs))  # bytes not coded yet
        covered, kinds = np.zeros(len(runs)), np.zeros(len(runs))  # what longer contexts exclude
        for level in range(self.depth, -1, -1):
            here = self.levels[level]
            own = runs[left]
            at, known = _found(here.names, self.context(own, level))
            if not known.any():
                continue
            at, rows = at[known], left[known]
            fresh = here.kinds[at] - kinds[rows]
            total = here.total[at] - covered[rows] + fresh
            place, seen = _found(here.nodes, self.node(runs[rows], level))
            share = np.where(seen, here.counts[place], fresh)
            told = fresh > 0  # else the longer context has seen the same bytes
            out[rows[told]] -= np.log2(share[told] / total[told])
            covered[rows], kinds[rows] = here.covered[at], here.kinds[at]
            coded = np.zeros(len(left), bool)
            coded[np.flatnonzero(known)[seen]] = True
            left = left[~coded]
        if len(left):
            out[left] += np.log2(256 - (self.levels[0].kinds[0] if len(self.levels[0].kinds) else 0))
        return out


# -- learning ---------------------------------------------------------------


def held_out(doc_id: str = "doc_id") -> Column:
    remainder = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


def training_pieces(docs: DataFrame, pieces: int = PIECES, piece: int = PIECE) -> DataFrame:
    """``lang, piece``: at most ``pieces`` rows, drawn by hash."""
    training = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "doc_id", F.col("lang").cast("string").alias("lang"), "text",
        F.expr(f"(length(text) + {piece - 1}) div {piece}").alias("parts"),
    ).where("parts > 0")
    sizes = training.groupBy("lang").agg(F.sum("parts").alias("parts"))
    chosen = materialize(sizes.orderBy(F.desc("parts"), "lang").limit(pieces), "languages")
    share = pieces // max(1, chosen.count())
    grain = 1 << 30
    # a draw that holds somewhat more than the share, then the share itself
    drawn = (
        training.join(chosen.withColumnRenamed("parts", "all_parts"), "lang")
        .withColumn("limit", F.lit(grain) * (F.lit(1.25) * share + 50) / F.greatest("all_parts", F.lit(1)))
        .withColumn("row_hash", F.xxhash64("doc_id", "text"))
        .withColumn("no", F.explode(F.expr(
            f"filter(sequence(0L, parts - 1L, 1L), i -> pmod(xxhash64(row_hash, i), {grain}) < limit)")))
        .select("lang", F.xxhash64("row_hash", "no").alias("draw"),
                F.expr(f"substring(text, CAST(no * {piece} + 1 AS INT), {piece})").alias("piece"))
        if share else training.limit(0).select("lang", F.lit(0).alias("draw"), F.col("text").alias("piece"))
    )
    order = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("draw", F.lit(grain)), "draw", "piece"))
    return drawn.withColumn("at", order).where(F.col("at") <= share).select("lang", "piece")


def learn_languages(docs: DataFrame, pieces: int = PIECES, piece: int = PIECE, depth: int = DEPTH) -> dict[str, Tree]:
    """The tree of every language; its size is bounded by that of the sample."""

    def fitted(key: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        tree = Tree([p for p in map(coded_form, sample["piece"]) if p], depth)
        return pd.DataFrame({"lang": [key[0]], "tree": [pickle.dumps(tree)]})

    trees = training_pieces(docs, pieces, piece).groupBy("lang").applyInPandas(fitted, "lang string, tree binary")
    return {r["lang"]: pickle.loads(r["tree"]) for r in sorted(trees.collect(), key=lambda r: r["lang"].encode())}


# -- prediction -------------------------------------------------------------


def _slices(texts: list[bytes], depth: int, size: int) -> Iterator[list[tuple[int, bytes, bytes]]]:
    """``(owner, bytes before, bytes)`` of all texts, about ``size`` bytes at a time."""
    held, out = 0, []
    for owner, text in enumerate(texts):
        for at in range(0, len(text), size):
            body = text[at : at + size]
            out.append((owner, text[max(0, at - depth) : at], body))
            held += len(body)
            if held >= size:
                yield out
                held, out = 0, []
    if out:
        yield out


def code_lengths(trees: list[Tree], texts: list[bytes], size: int = SLICE) -> np.ndarray:
    """Bits of each text (rows) by each tree (columns)."""
    out = np.zeros((len(texts), len(trees)))
    for segments in _slices(texts, trees[0].depth, size):
        runs, owner, _ = runs_of(segments, trees[0].depth)
        runs, own = np.unique(runs, return_inverse=True)
        for k, tree in enumerate(trees):
            out[:, k] += np.bincount(owner, tree.bits(runs)[own], len(texts))
    return out


def has_letter(text: str, coded: bytes) -> bool:
    return any(0x61 <= b <= 0x7A for b in coded) or any(c.isalpha() for c in text)


def predict_languages(
    docs: DataFrame, trees: dict[str, Tree] | None = None, size: int = SLICE
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, bits_per_byte`` of every document.

    ``trees``: learned from the documents that are not held out, if not given.
    """
    names = list(trees := learn_languages(docs) if trees is None else trees)
    shared = docs.sparkSession.sparkContext.broadcast(list(trees.values()))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string," \
        " score double, bits_per_byte double"

    def predicted(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            texts = [(t or b"").decode(errors="replace") for t in frame.column("text").to_pylist()]
            coded = [coded_form(t) for t in texts]
            told = np.array([bool(names) and has_letter(t, c) for t, c in zip(texts, coded)], bool)
            del texts
            best, score, rate = np.zeros(len(coded), np.int64), np.zeros(len(coded)), np.full(len(coded), np.nan)
            if told.any():
                bits = code_lengths(shared.value, coded, size)
                best = bits.argmin(axis=1)
                least = bits.min(axis=1)
                score = np.where(told, 1 / np.exp2(least[:, None] - bits).sum(axis=1), 0.0)
                rate = np.where(told, least / np.maximum([len(c) for c in coded], 1), np.nan)
            yield pa.RecordBatch.from_arrays(
                [
                    frame.column("doc_id"), frame.column("held_out"),
                    pa.array([names[b] if t else UNKNOWN for b, t in zip(best, told)], pa.string()),
                    pa.array(score, pa.float64()), pa.array(rate, pa.float64(), from_pandas=True),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"],
            )

    rows = docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(predicted, schema)
