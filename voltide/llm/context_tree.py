"""Language-model scores by context-tree weighting.

A text is a row of bytes; each byte is eight binary decisions. For every decision
there is a tree of contexts, the bytes before it up to ``DEPTH``; a node's estimate is
Krichevsky-Trofimov's, and a node's weighted probability is half its own estimate
and half the product of its children's, so all depths are mixed by how well they
foretold the training data. The prediction follows the tree from the root with the
weights that training leaves at each node.

Statistics cover every training document. Documents are held in blocks of about
``BLOCK`` bytes. A block sends its different words and its different byte runs of
``DEPTH + 1``, sorted and packed, to the parts of a hash or context range; each part
adds up all blocks and sends back what each block asked for, in its order. So tasks
hold a block or a range, the model is never in one place but for the two topmost
levels, whose size is bounded (65,536 nodes each of 255 decisions), and what is
shuffled grows with the input.

Cases: a null text counts as empty: one end token, one end byte. A null id is not
held out. Repeated rows count and are scored each. Other columns are ignored. An
empty table gives an empty table; with no training document every estimate is even.
Words are counted by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.llm.common import as_text, materialize, shuffle_parts, with_type

DEPTH = 5
BLOCK = 8_000_000
FOLDS, HELD_OUT = 7, 2
#: Context bytes that name a range; the levels above them are the bounded top.
TOP = 2
END = 0
#: Positions of a block that are sorted at once.
SLICE = 1_000_000
#: Different words of a range, about.
RANGE = 1_000_000


# -- packing ----------------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Whole numbers, sorted ones best as differences, as byte planes."""
    values = np.ascontiguousarray(values)
    width = values.dtype.itemsize
    planes = values.view(np.uint8).reshape(-1, width).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(data: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


# -- the model --------------------------------------------------------------


def runs_of(text: bytes, depth: int = DEPTH) -> np.ndarray:
    """For each byte and the end: the bytes before it, latest first, then itself."""
    buf = np.frombuffer(bytes(depth) + text + bytes([END]), np.uint8).astype(np.uint64)
    n = len(text) + 1
    out = buf[depth:].copy()
    for back in range(1, depth + 1):
        out |= buf[depth - back : depth - back + n] << np.uint64(8 * (depth + 1 - back))
    return out


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x > 0, by Stirling's series at x + 8."""
    y = x + 8.0
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    product = x.copy()
    for k in range(1, 8):
        product *= x + k
    return series - np.log(product)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return (
        log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - math.log(math.pi) - log_gamma(zeros + ones + 1.0)
    )


def weigh(zeros, ones, below: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Log weighted probability of nodes and the weight of their own estimate."""
    own = log_kt(zeros, ones)
    if below is None:
        return own, np.ones(len(own))
    own = own + math.log(0.5)
    whole = np.logaddexp(own, below + math.log(0.5))
    return whole, np.exp(own - whole)


def decision(byte: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """The node of a decision (1 to 255) and the value decided."""
    return (1 << bit) | (byte >> (8 - bit)), (byte >> (7 - bit)) & 1


def subtree(runs: np.ndarray, counts: np.ndarray, depth: int = DEPTH, top: int = TOP):
    """The part of the trees from level ``top`` down, for whole context ranges.

    ``runs``: sorted different runs, ``counts``: how often each was trained on.
    Returns for each bit the predictions of the runs' bits and the nodes of level
    ``top``: ``(context and decision, zeros, ones, log weighted probability)``.
    """
    byte = (runs & np.uint64(255)).astype(np.int64)
    counts = counts.astype(np.float64)
    predictions, nodes = [], []
    for bit in range(8):
        node, value = decision(byte, bit)
        # runs are sorted by context, then byte, so nodes of the lowest level are too
        names = ((runs >> np.uint64(8)) << np.uint64(8)) | node.astype(np.uint64)
        first = np.r_[True, names[1:] != names[:-1]] if len(names) else np.zeros(0, bool)
        own, names = np.cumsum(first) - 1, names[first]
        ones = np.bincount(own, counts * value, len(names))
        zeros = np.bincount(own, counts * (1 - value), len(names))
        below, levels = None, []
        for level in range(depth, top - 1, -1):
            below, weight = weigh(zeros, ones, below)
            estimate = (np.where(value == 1, ones[own], zeros[own]) + 0.5) / (zeros[own] + ones[own] + 1.0)
            levels.append((weight[own], estimate))
            if level > top:
                up = ((names >> np.uint64(16)) << np.uint64(8)) | (names & np.uint64(255))
                names, parent = np.unique(up, return_inverse=True)
                zeros, ones, below = (np.bincount(parent, x, len(names)) for x in (zeros, ones, below))
                own = parent[own]
        chance = np.zeros(len(runs))
        for weight, estimate in levels:  # deepest first
            chance = weight * estimate + (1 - weight) * chance
        predictions.append(chance)
        nodes.append((names, zeros, ones, below))
    return predictions, nodes


class Top:
    """The levels above ``TOP``: weight and counts of each node, by context byte."""

    def __init__(self, names: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        """From the nodes of level 1, ``byte * 256 + decision``, with their children's sums."""
        self.levels = []
        for size in (256 * 256, 256):
            zeros, ones, below = (np.bincount(names, x, size) for x in (zeros, ones, below))
            below, weight = weigh(zeros, ones, below)
            self.levels.append((weight, zeros, ones))
            names = np.arange(size) % 256

    def mixed(self, chance: np.ndarray, latest: np.ndarray, node: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Predictions of level 2 mixed with the levels above."""
        for (weight, zeros, ones), at in zip(self.levels, (latest * 256 + node, node)):
            estimate = (np.where(value == 1, ones[at], zeros[at]) + 0.5) / (zeros[at] + ones[at] + 1.0)
            chance = weight[at] * estimate + (1 - weight[at]) * chance
        return chance


def log_chances(runs: np.ndarray, counts: np.ndarray, top: Top, depth: int = DEPTH) -> np.ndarray:
    """Log10 probability of each run's last byte after the bytes before it."""
    byte = (runs & np.uint64(255)).astype(np.int64)
    latest = (runs >> np.uint64(8 * depth)).astype(np.int64)
    total = np.zeros(len(runs))
    for bit, chance in enumerate(subtree(runs, counts, depth)[0]):
        node, value = decision(byte, bit)
        total += np.log10(top.mixed(chance, latest, node, value))
    return total


# -- blocks -----------------------------------------------------------------

#: No word holds a space.
END_WORD = xxhash.xxh64_intdigest(b" end")
WORDS, RUNS, TOKENS = 0, 1, 2


def word_hashes(text: bytes) -> list[int]:
    """Hashes of the words of a lower-case text, then of the end."""
    return [*map(xxhash.xxh64_intdigest, text.split()), END_WORD]


def _texts(lens, payload: bytes) -> list[bytes]:
    whole = zstandard.ZstdDecompressor().decompress(payload) if len(payload) else b""
    ends = np.cumsum(lens).tolist()
    return [whole[a:b] for a, b in zip([0, *ends], ends)]


def _run_slices(texts: list[bytes], depth: int):
    """``(document of each position, runs)``, a bounded number of positions at a time."""
    owner, runs, held = [], [], 0
    for i, text in enumerate(texts):
        found = runs_of(text, depth)
        for at in range(0, len(found), SLICE):
            part = found[at : at + SLICE]
            owner.append(np.full(len(part), i))
            runs.append(part)
            held += len(part)
            if held >= SLICE:
                yield np.concatenate(owner), np.concatenate(runs)
                owner, runs, held = [], [], 0
    if runs:
        yield np.concatenate(owner), np.concatenate(runs)


def _ranged(values: np.ndarray, parts: int, kind: int, depth: int) -> np.ndarray:
    """The range of each word hash, or of the last ``TOP`` context bytes of each run."""
    if kind == WORDS:
        return (values % np.uint64(parts)).astype(np.int64)
    context = values >> np.uint64(8 * (depth + 1 - TOP))
    return ((context * np.uint64(0x9E3779B1) >> np.uint64(7)) % np.uint64(parts)).astype(np.int64)


def _slices(texts: list[bytes], kind: int, depth: int):
    """``(document, word hash or run)`` of each position, a bounded number at a time."""
    if kind == RUNS:
        yield from _run_slices(texts, depth)
        return
    found = [np.array(word_hashes(t), np.uint64) for t in texts]
    if found:
        yield np.repeat(np.arange(len(found)), [len(f) for f in found]), np.concatenate(found)


def _in_ranges(found: np.ndarray, parts: int, kind: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The order in which ranges list sorted values, and the range of each in that order."""
    part = _ranged(found, parts, kind, depth)
    order = np.argsort(part, kind="stable")
    return order, part[order]


def _counted(texts: list[bytes], held, kind: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted different words or runs of a block and how often training texts have each."""
    names, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for out in (False, True):
        for _, values in _slices([t for t, h in zip(texts, held) if h == out], kind, depth):
            found, n = np.unique(values, return_counts=True)
            names.append(found)
            counts.append(np.zeros(len(n), np.int64) if out else n)
    found, own = np.unique(np.concatenate(names), return_inverse=True)
    return found, np.bincount(own, np.concatenate(counts), len(found)).astype(np.int64)


def _blocks(docs: DataFrame, block: int) -> DataFrame:

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, no = TaskContext.get().partitionId(), 0
        ids, held, texts, size = [], [], [], 0

        def made() -> pd.DataFrame:
            packed = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            return pd.DataFrame({
                "block": [(part << 32) + no], "doc_ids": [ids], "held": [held],
                "lens": [[len(t) for t in texts]], "size": [size], "payload": [packed],
            })

        for frame in frames:
            for doc_id, out, text in zip(frame["doc_id"], frame["held"], frame["text"]):
                ids.append(doc_id)
                held.append(bool(out))
                texts.append(text.encode().lower())
                size += len(texts[-1])
                if size >= block:
                    yield made()
                    no, ids, held, texts, size = no + 1, [], [], [], 0
        if ids:
            yield made()

    rows = docs.select(
        as_text("doc_id"),
        F.coalesce(
            F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False)
        ).alias("held"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.mapInPandas(
        gather,
        "block long, doc_ids array<string>, held array<boolean>, lens array<int>, size long, payload binary",
    )


def score_documents(docs: DataFrame, depth: int = DEPTH, block: int = BLOCK) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte`` of every document; a hash of the id says which are held out.

    ``base_score``: words by their counts with one added; ``score``: the text's bytes
    by the context tree, A-Z in lower case. Both are log10 probabilities. The logarithm
    of a byte's chance has the 24 bits of a float, their sum those of a double.
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    blocks = materialize(_blocks(docs, block), "blocks")
    volume = blocks.agg(F.sum("size")).first()[0] or 0
    # ranges of about RANGE different words, if one word in 20 bytes is new to its block
    parts = int(max(shuffle_parts(spark), volume // (20 * RANGE)))

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, held, lens, payload in zip(frame["block"], frame["held"], frame["lens"], frame["payload"]):
                texts = _texts(lens, payload)
                for kind in (WORDS, RUNS):
                    found, counts = _counted(texts, held, kind, depth)
                    order, part = _in_ranges(found, parts, kind, depth)
                    found, counts = found[order], counts[order]
                    edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else [0]
                    yield pd.DataFrame({
                        "kind": kind, "block": name, "part": [int(part[a]) for a in edges[:-1]],
                        "found": [pack_sorted(found[a:b]) for a, b in zip(edges, edges[1:])],
                        "counts": [pack(counts[a:b].astype(np.uint32)) for a, b in zip(edges, edges[1:])],
                        "n": [int(counts[a:b].sum()) for a, b in zip(edges, edges[1:])],
                    })

    sent = materialize(
        blocks.select("block", "held", "lens", "payload").mapInPandas(
            send, "kind int, block long, part int, found binary, counts binary, n long"
        ),
        "statistics",
    )

    def added(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        each = [unpack_sorted(f) for f in group["found"]]
        names, own = np.unique(np.concatenate(each), return_inverse=True)
        counts = np.concatenate([unpack(c, np.uint32) for c in group["counts"]])
        total = np.bincount(own, counts, len(names)).astype(np.int64)
        return names, total, np.split(own, np.cumsum([len(e) for e in each])[:-1])

    def answers(group: pd.DataFrame, values: np.ndarray, own: list, known: int) -> pd.DataFrame:
        return pd.DataFrame({
            "kind": group["kind"].iloc[0], "block": group["block"].to_numpy(), "part": group["part"].iloc[0],
            "answer": [pack(values[o]) for o in own], "known": [known, *[0] * (len(own) - 1)],
        })

    def nodes(group: pd.DataFrame) -> pd.DataFrame:
        names, total, _ = added(group)
        found = subtree(names, total, depth)[1]
        # summed up to level 1 within this range
        level = [((f[0] >> np.uint64(16)) << np.uint64(8) | (f[0] & np.uint64(255))).astype(np.int64) for f in found]
        out = pd.DataFrame({
            "name": np.concatenate(level),
            **{c: np.concatenate([f[i] for f in found]) for i, c in ((1, "zeros"), (2, "ones"), (3, "below"))},
        })
        return out.groupby("name", as_index=False).sum()

    runs = sent.where(f"kind = {RUNS}")
    # bounded: 256 bytes by 255 decisions
    level = (
        runs.groupBy("part").applyInPandas(nodes, "name long, zeros double, ones double, below double")
        .groupBy("name").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")]).collect()
    )
    figures = np.array([(r["zeros"], r["ones"], r["below"]) for r in level]).reshape(-1, 3)
    top = spark.sparkContext.broadcast(Top(np.array([r["name"] for r in level], np.int64), *figures.T))

    def chances(group: pd.DataFrame) -> pd.DataFrame:
        names, total, own = added(group)
        return answers(group, log_chances(names, total, top.value, depth).astype(np.float32), own, 0)

    def totals(group: pd.DataFrame) -> pd.DataFrame:
        names, total, own = added(group)
        return answers(group, total.astype(np.uint32), own, int((total > 0).sum()))

    schema = "kind int, block long, part int, answer binary, known long"
    replies = materialize(
        runs.groupBy("part").applyInPandas(chances, schema).unionByName(
            sent.where(f"kind = {WORDS}").groupBy("part").applyInPandas(totals, schema)
        ),
        "answers",
    )
    train_tokens = sent.where(f"kind = {WORDS}").agg(F.sum("n")).first()[0] or 0
    different = replies.agg(F.sum("known")).first()[0] or 0
    unit = math.log10(train_tokens + different + 1)

    def score(key: tuple, own: pd.DataFrame, replied: pd.DataFrame) -> pd.DataFrame:
        row = own.iloc[0]
        texts = _texts(row["lens"], row["payload"])
        n = len(texts)

        def answered(kind: int, dtype):
            """``(document, answer)`` of each position; every position is sorted once."""
            slices = []
            for owner, values in _slices(texts, kind, depth):
                names, at = np.unique(values, return_inverse=True)
                slices.append((owner.astype(np.int32), names, at.astype(np.int32)))
            found = np.unique(np.concatenate([names for _, names, _ in slices]))
            order, _ = _in_ranges(found, parts, kind, depth)
            values = np.empty(len(found))
            values[order] = np.concatenate(
                [unpack(a, dtype) for a in replied[replied["kind"] == kind].sort_values("part")["answer"]]
            )
            for owner, names, at in slices:
                yield owner, values[np.searchsorted(found, names)][at]

        base, total = np.zeros(n), np.zeros(n)
        known, tokens = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for owner, counts in answered(WORDS, np.uint32):
            base += np.bincount(owner, np.log10(counts + 1), n)
            known += np.bincount(owner[counts > 0], minlength=n)
            tokens += np.bincount(owner, minlength=n)
        for owner, logs in answered(RUNS, np.float32):
            total += np.bincount(owner, logs, n)
        return pd.DataFrame({
            "doc_id": pd.Series(list(row["doc_ids"]), dtype=object), "held_out": list(row["held"]),
            "n_tokens": tokens, "n_known": known,
            "train_tokens": train_tokens, "base_score": base - tokens * unit, "score": total,
            "bits_per_byte": -total * math.log2(10) / (np.array(row["lens"]) + 1),
        })

    scored = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(
        score,
        "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long,"
        " base_score double, score double, bits_per_byte double",
    )
    return with_type(scored, "doc_id", id_type)
