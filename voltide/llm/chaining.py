"""Substring dedup by collinear chaining of shared k-mers.

Each document is reduced to seeds: of every ``WINDOW`` successive runs of ``K``
words the one with the least hash. Seeds with one hash are joined to the places
of that hash in the document with the smallest id, so a passage that a third of all
documents share costs one row a seed, never a pair of documents. Matches of a
document with one source are chained in order, with a cost for gaps, through a
Fenwick tree of best scores. Chains are then aligned word by word: seeds are
extended at both ends and the gaps between them are aligned, which finds passages
with small changes inside. A single match is aligned too, for a passage with many changes
may have no other. A document and a source in which a seed has many pairs of places (a
repeated unit) are compared as a whole, at every shift of one along the other.

A passage counts if it, with passages that touch it, has ``LEAST_WORDS`` words or
more and ``LEAST_SAME`` of its words stand in the source too.

Cases: a null or empty text has no seeds. Rows with a null id are not compared, and
:func:`drop_passages` leaves them as they are. Rows that share an id are one
document to others, and are not compared with each other; each is aligned by its
own text. Repeats within a document do not count. Other columns are kept by
:func:`drop_passages` and ignored by :func:`passages`. Empty tables give empty tables.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain as chain_items

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from voltide.llm.common import materialize, scratch_path, words_of
from voltide.llm.url_filter import build_filter, maybe_listed
from voltide.session import job

K = 6
WINDOW = 6
LEAST_WORDS = 50
LEAST_SAME = 0.8
#: Words of the shortest part that may join with a neighbour to reach the least.
LEAST_PART = 16
#: Words that may stand between two matches of one passage.
MOST_GAP = 40
#: Gain of a match and cost of a word skipped on either side.
GAIN, GAP_COST = 8.0, 0.25
#: Words to either side of a chain in which it may be extended.
AROUND = 96
#: An extension ends where it has lost so much from its best: a changed word loses 3.
MOST_LOST = 15
#: Pairs of one seed's places that are sent on; texts with a seed of more are compared place by place.
MOST_PAIRS = 64
#: Matches that are chained at once where two texts are compared place by place.
CHAINED = 200_000

#: Characters of the texts whose seeds are made at once, and of those that are aligned together.
SEEDED, AT_ONCE = 100_000, 400_000
#: Chains aligned at once, and pairs of lengths compared at once.
ALIGNED, LENGTHS = 1_000, 100_000

_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p) for p in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
    )
)  # the primes of XXH64


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def hashes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of slices of bytes, all at once; ``data`` has 8 bytes more than the slices reach."""
    eight = np.lib.stride_tricks.as_strided(data[:8].view("<u8"), (len(data) - 7,), (1,))
    size = ends - starts
    stripes = size >> 5
    h = np.full(len(starts), _P5)
    long = np.flatnonzero(stripes)
    if len(long):
        at, left = starts[long], stripes[long]
        lanes = [np.full(len(long), np.uint64(v)) for v in ((int(_P1) + int(_P2)) % 2**64, int(_P2), 0, 2**64 - int(_P1))]
        for turn in range(int(left.max())):
            go = np.flatnonzero(left > turn) if turn else slice(None)
            for n, lane in enumerate(lanes):
                lane[go] = _rotated(lane[go] + eight[at[go] + (32 * turn + 8 * n)] * _P2, 31) * _P1
        some = _rotated(lanes[0], 1) + _rotated(lanes[1], 7) + _rotated(lanes[2], 12) + _rotated(lanes[3], 18)
        for lane in lanes:
            some = (some ^ (_rotated(lane * _P2, 31) * _P1)) * _P1 + _P4
        h[long] = some
    h += size.astype(np.uint64)
    at = starts + (stripes << 5)
    rest = size & 31
    for n in range(3):
        go = np.flatnonzero(rest >= 8 * (n + 1))
        h[go] = _rotated(h[go] ^ (_rotated(eight[at[go] + 8 * n] * _P2, 31) * _P1), 27) * _P1 + _P4
    at += rest & 24
    go = np.flatnonzero(rest & 4)
    h[go] = _rotated(h[go] ^ ((eight[at[go]] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
    at += rest & 4
    for n in range(3):
        go = np.flatnonzero((rest & 3) > n)
        h[go] = _rotated(h[go] ^ (data[at[go] + n].astype(np.uint64) * _P5), 11) * _P1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def seeds_of_all(texts: list[str], k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and word positions of the seeds of several texts, and the number of each text's seeds."""
    joined = [b" ".join(words_of(t)) for t in texts]
    data = np.frombuffer(b" ".join([*joined, b" " * 8]), np.uint8)
    lengths = np.array([len(j) for j in joined], np.int64)
    ends = np.cumsum(lengths + 1)[lengths > 0] - 1  # of texts that have words
    begins = ends - lengths[lengths > 0]
    spaces = np.flatnonzero(data == 32)
    edge = np.searchsorted(spaces, ends)  # the space behind a text's last word
    first = np.searchsorted(spaces, begins)
    n = np.maximum(edge - first + 2 - k, 0)  # runs of k words of each
    text = np.repeat(np.arange(len(n)), n)
    offset = np.cumsum(n) - n
    place = np.arange(len(text)) - offset[text]
    word = place + first[text]
    starts = np.where(place > 0, spaces[word - 1] + 1, begins[text])
    hashes = hashes_of(data, starts, spaces[word + k - 1])
    # the least of every window, the first of equal ones; a text with fewer runs is one window
    total = len(hashes)
    reach = np.minimum(np.arange(total) + window, (offset + n)[text])
    whole = (place == 0) | (reach - np.arange(total) == window)
    least, at = hashes.copy(), np.arange(total)
    for j in range(1, min(window, total)):
        other = hashes[j:]
        less = np.flatnonzero((other < least[: total - j]) & (reach[: total - j] > np.arange(j, total)))
        least[less], at[less] = other[less], less + j
    at = at[whole]
    at = at[np.concatenate([at[:1] >= 0, at[1:] != at[:-1]])]
    counts = np.zeros(len(texts), np.int64)
    counts[lengths > 0] = np.bincount(text[at], minlength=len(n))
    return hashes[at].view(np.int64), place[at], counts


def seeds_of(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and word positions of the seeds of a text."""
    return seeds_of_all([text], k, window)[:2]


def pairs_of(here: np.ndarray, there: np.ndarray) -> np.ndarray:
    """All matches of a seed that stands at several places here or there."""
    return np.stack([np.repeat(here, len(there)), np.tile(there, len(here))], axis=1)


@lru_cache(maxsize=24)
def _nodes(size: int) -> tuple[list[tuple], list[tuple]]:
    """For each rank, the nodes of a Fenwick tree that a query of the ranks before it reads and an update writes."""
    read, write = [()], [()] * (size + 1)
    for r in range(1, size + 1):
        read.append((r, *read[r & (r - 1)]))
    for r in range(size, 0, -1):
        up = r + (r & -r)
        write[r] = (r, *write[up]) if up <= size else (r,)
    return read[:size], write[1:]


def _linked(here: list[int], there: list[int], gain: float, cost: float) -> list[list[int]]:
    """Chains of matches in ascending order without repeats, as indices, the best first."""
    n = len(here)
    score, before = [gain] * n, [-1] * n
    if all(a < b for a, b in zip(here, here[1:])) and all(a < b for a, b in zip(there, there[1:])):
        # each match is a better end than any before it
        for i in range(1, n):
            more = score[i - 1] - cost * (here[i] - here[i - 1] + there[i] - there[i - 1])
            if more > 0:
                score[i] += more
                before[i] = i - 1
    else:
        rank_of = {q: r for r, q in enumerate(sorted(set(there)))}
        read, write = _nodes(1 << (len(rank_of) - 1).bit_length())
        best, who = [-math.inf] * (len(write) + 1), [-1] * (len(write) + 1)
        at = 0
        while at < n:
            end, p = at + 1, here[at]
            while end < n and here[end] == p:
                end += 1
            waiting = []
            for i in range(at, end):
                r = rank_of[there[i]]
                value, found = -math.inf, -1
                for node in read[r]:  # of places before
                    if best[node] > value:
                        value, found = best[node], who[node]
                passed = cost * (p + there[i])
                if value > passed:
                    score[i] += value - passed
                    before[i] = found
                waiting.append((i, score[i] + passed, write[r]))
            for i, value, nodes in waiting:
                for node in nodes:
                    if value > best[node]:
                        best[node], who[node] = value, i
            at = end
    used = [False] * n
    out = []
    for i in sorted(range(n), key=[-x for x in score].__getitem__):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(i)
            i = before[i]
        if path:
            out.append(path[::-1])
    return out


def chain(matches: np.ndarray, gain: float = GAIN, cost: float = GAP_COST) -> list[np.ndarray]:
    """Best chains of matches ``(place here, place there)``, each used once.

    Score of a chain: ``gain`` a match less ``cost`` for each word skipped on either
    side. The best predecessor with smaller places is the best value over a prefix
    of places there, kept in a Fenwick tree while places here are swept.
    """
    packed = np.unique((matches[:, 0] << 32) | matches[:, 1])
    matches = np.stack([packed >> 32, packed & 0xFFFFFFFF], axis=1)
    return [matches[path] for path in _linked(matches[:, 0].tolist(), matches[:, 1].tolist(), gain, cost)]


def parts_of(path: np.ndarray, most_gap: int = MOST_GAP, k: int = K) -> list[np.ndarray]:
    """A chain cut where more than ``most_gap`` words stand between two matches."""
    if len(path) == 1:
        return [path]
    far = np.flatnonzero((np.diff(path, axis=0) > most_gap + k).any(axis=1)) + 1
    return np.split(path, far)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two short lists."""
    if len(a) == len(b) and (a == b).all():
        return len(a)
    # a bit for each place of a list: unset where the length goes up
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for y in b.tolist():
        hit = row & places.get(y, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _all_parts(matches: np.ndarray, k: int = K, most_gap: int = MOST_GAP) -> tuple[np.ndarray, np.ndarray]:
    """The matches in the order of their chains, and where :func:`parts_of` would begin a part."""
    packed = np.unique((matches[:, 0] << 32) | matches[:, 1])
    here, there = packed >> 32, packed & 0xFFFFFFFF
    paths = _linked(here.tolist(), there.tolist(), GAIN, GAP_COST)
    order = np.fromiter(chain_items.from_iterable(paths), np.int64, len(packed))
    path = np.stack([here[order], there[order]], axis=1)
    begins = np.zeros(len(order), bool)
    begins[np.cumsum([0, *map(len, paths[:-1])])] = True
    begins[1:] |= (np.diff(path, axis=0) > most_gap + k).any(axis=1)
    return path, np.flatnonzero(begins)


def _linked_all(
    matches: np.ndarray, size: np.ndarray, gain: float = GAIN, cost: float = GAP_COST
) -> tuple[np.ndarray, np.ndarray]:
    """:func:`_linked` of several lists of matches at once, ``size`` of them one behind the other.

    The n-th places here of all lists are taken together, each list with a Fenwick tree of its own.
    Returns the matches in the order of their chains, as indices, and a number for each one's chain.
    """
    of = np.repeat(np.arange(len(size)), size)
    here, there = matches.T
    places, place = np.unique((of << 32) | there, return_inverse=True)
    first = np.searchsorted(places, np.arange(len(size)) << 32)
    kinds = np.diff(first, append=len(places))
    nodes = np.array([1 << (x - 1).bit_length() for x in kinds.tolist()])
    base = np.cumsum(nodes + 1) - (nodes + 1)
    last = int(base[-1] + nodes[-1]) + 1  # stands for the nodes past the end of a tree
    best, who = np.full(last + 1, -np.inf), np.full(last + 1, -1)
    best[last] = np.inf
    new = np.ones(len(of), bool)
    new[1:] = (here[1:] != here[:-1]) | (of[1:] != of[:-1])
    group = np.cumsum(new)
    step = group - group[np.cumsum(size) - size][of]
    order = np.argsort(step, kind="stable")
    edges = np.cumsum([0, *np.bincount(step)]).tolist()
    # the nodes that a query of the places before one reads and an update of it writes
    levels = int(nodes.max()).bit_length()
    read, write = np.empty((2, len(places), levels), np.int64)
    ahead = np.arange(len(places)) - np.repeat(first, kinds)
    up, start, end = ahead + 1, np.repeat(base, kinds), np.repeat(nodes, kinds)
    for level in range(levels):
        read[:, level] = start + ahead
        write[:, level] = np.where(up <= end, start + up, last)
        ahead &= ahead - 1
        up += up & -up
    place, passed = place[order], cost * (here + there)[order]
    score, before = np.full(len(of), gain), np.full(len(of), -1)
    for low, high in zip(edges, edges[1:]):
        at_once, skipped = place[low:high], passed[low:high]
        some = read[at_once]
        values = best[some]
        turn, at = np.arange(high - low), values.argmax(axis=1)
        more = values[turn, at] - skipped
        linked = more > 0
        items = order[low:high]
        before[items[linked]] = who[some[turn, at]][linked]
        now = gain + np.where(linked, more, 0)
        score[items] = now
        # the last that is written stays: the first match with the best score
        some, now = write[at_once[::-1]], (now + skipped)[::-1, None]
        row, at = np.nonzero(now > best[some])
        some, now = some[row, at], now[row, 0]
        np.maximum.at(best, some, now)
        won = now == best[some]
        who[some[won]] = items[::-1][row[won]]
    # a match goes to the best of the chains that lead through it
    chain_of = np.empty(len(of), np.int64)
    chain_of[np.lexsort((-score, of))] = np.arange(len(of))
    owner, back = chain_of.tolist(), before.tolist()
    for i in range(len(owner) - 1, -1, -1):
        j = back[i]
        if j >= 0 and owner[i] < owner[j]:
            owner[j] = owner[i]
    owner = np.array(owner)
    order = np.argsort(owner, kind="stable")
    return order, owner[order]


def _parts_of_all(lists: list[np.ndarray], k: int = K, most_gap: int = MOST_GAP) -> list[tuple[np.ndarray, np.ndarray]]:
    """:func:`_all_parts` of several lists of matches, each in ascending order without repeats."""
    out: list = [None] * len(lists)
    together = []
    for n, matches in enumerate(lists):
        steps = np.count_nonzero(np.diff(matches[:, 0])) + 1
        # few matches of each of many places are quicker one by one
        if steps == len(matches) or (steps > 256 and len(matches) < 16 * steps):
            out[n] = _all_parts(matches, k, most_gap)
        else:
            together.append(n)
    if together:
        matches, size = np.concatenate([lists[n] for n in together]), np.array([len(lists[n]) for n in together])
        order, owner = _linked_all(matches, size)
        path = matches[order]
        begins = np.ones(len(path), bool)
        begins[1:] = (np.diff(owner) != 0) | (np.diff(path, axis=0) > most_gap + k).any(axis=1)
        edges = np.cumsum([0, *size]).tolist()
        for n, low, high in zip(together, edges, edges[1:]):
            out[n] = path[low:high], np.flatnonzero(begins[low:high])
    return out


def _equal(
    a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, n: np.ndarray, step: int, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Whether the words that follow two places, in direction ``step``, are equal, and whether both have them."""
    far = np.arange(width) * step
    there = np.arange(width) < n[:, None]
    equal = a.take(at_a[:, None] + far, mode="clip") == b.take(at_b[:, None] + far, mode="clip")
    return equal & there, there


def _extend(
    a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, n: np.ndarray, step: int, width: int = 32
) -> tuple[np.ndarray, np.ndarray]:
    """How far two lists agree from each pair of places, past single changes, over ``n`` words: words, of them equal."""
    total, most, far, done = np.zeros((4, len(n)), np.int64)  # at the last word, at the best one, and these words
    left = np.arange(len(n))
    while len(left):
        ahead = done[left] * step
        equal, there = _equal(a, b, at_a[left] + ahead, at_b[left] + ahead, n[left] - done[left], step, width)
        done[left] += width
        # nothing but equal words: the last one is the best
        plain = equal.all(axis=1)
        rows = left[plain]
        total[rows] += width
        more = rows[total[rows] > most[rows]]
        most[more], far[more] = total[more], done[more]
        rest, equal, there = left[~plain], equal[~plain], there[~plain]
        gain = np.where(equal, np.int32(1), np.where(there, np.int32(-3), np.int32(-4 - MOST_LOST)))
        now = np.cumsum(gain, axis=1, dtype=np.int32) + total[rest][:, None]
        fallen = np.maximum(np.maximum.accumulate(now, axis=1), most[rest][:, None]) - now > MOST_LOST
        gained = np.where(np.logical_or.accumulate(fallen, axis=1), 0, now)
        best = gained.argmax(axis=1)
        gained = gained[np.arange(len(rest)), best]
        more = gained > most[rest]
        most[rest[more]], far[rest[more]] = gained[more], (done[rest] - width + best + 1)[more]
        total[rest] = now[:, -1]
        left = np.concatenate([rows, rest[~fallen.any(axis=1)]])
        left = left[n[left] > done[left]]
        width = min(4 * width, 256)
    return far, (most + 3 * far) // 4


def _stops(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row the lengths at which two lists may stop agreeing, each after two equal words, the equal
    words up to there, and how many lengths a row has; others are 0."""
    row, at = np.nonzero(equal[:, 1:] & equal[:, :-1])
    n = np.bincount(row, minlength=len(equal))
    turn = np.arange(len(row)) - (np.cumsum(n) - n)[row] + 1
    words = np.zeros((len(equal), n.max(initial=0) + 1), np.int32)
    same = np.zeros_like(words)
    words[row, turn] = at + 2
    same[row, turn] = np.cumsum(equal, axis=1, dtype=np.int32)[row, at + 1]
    return words, same, n + 1


def _longest(
    left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...], size: np.ndarray, same: np.ndarray, share: float
) -> np.ndarray:
    """For each row the longest extension to both sides with which ``share`` of all words is equal:
    words to the left and equal ones of them, words to the right and equal ones."""
    out = np.zeros((len(size), 4), np.int64)
    (one, one_same, n_one), (two, two_same, n_two) = left, right
    # rows with about as many lengths are compared together
    kind = np.frexp(n_one)[1] * 64 + np.frexp(n_two)[1]
    for some in np.unique(kind).tolist():
        rows = np.flatnonzero(kind == some)
        x, y = int(n_one[rows].max()), int(n_two[rows].max())
        for low in range(0, len(rows), max(1, LENGTHS // (x * y))):
            at = rows[low : low + max(1, LENGTHS // (x * y))]
            words = one[at, :x, None] + two[at, None, :y] + size[at][:, None, None]
            equal = one_same[at, :x, None] + two_same[at, None, :y] + same[at][:, None, None]
            best = np.where(equal >= share * words, words, 0).reshape(len(at), -1).argmax(axis=1)
            i, j = best // y, best % y
            out[at] = np.stack([one[at, i], one_same[at, i], two[at, j], two_same[at, j]], axis=1)
    return out


def align_all(
    mine: np.ndarray, theirs: np.ndarray, matches: np.ndarray, heads: np.ndarray, k: int = K,
    least: int = LEAST_WORDS, share: float = LEAST_SAME, within: np.ndarray | None = None,
) -> list[tuple[int, int, int, int, int] | None]:
    """:func:`align` of many chains, one behind the other in ``matches``, each from one of ``heads`` on.

    ``within`` has a row for each chain: the texts it is of, as start and end in ``mine`` and in ``theirs``.
    """
    if within is None:
        within = np.tile([0, len(mine), 0, len(theirs)], (len(heads), 1))
    found, good = _spans(mine, theirs, matches, heads, k, least, share, within)
    return [tuple(span) if ok else None for span, ok in zip(found.tolist(), good.tolist())]


def _spans(
    mine: np.ndarray, theirs: np.ndarray, matches: np.ndarray, heads: np.ndarray, k: int, least: int, share: float,
    within: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """The rows of :func:`align_all` as an array, and which of them are not None."""
    found, good = np.zeros((len(heads), 5), np.int64), np.zeros(len(heads), bool)
    edges = np.concatenate([heads, [len(matches)]])
    for low in range(0, len(heads), ALIGNED):
        some = edges[low : low + ALIGNED + 1]
        rows, spans = _align_some(
            mine, theirs, matches[some[0] : some[-1]], some - some[0], k, least, share, within[low : low + ALIGNED]
        )
        found[low + rows], good[low + rows] = spans, True
    return found, good


def _align_some(mine, theirs, matches, edges, k, least, share, within) -> tuple[np.ndarray, np.ndarray]:
    heads, count, parts = edges[:-1], np.diff(edges), len(edges) - 1
    p, q = matches.T
    low_p, high_p, low_q, high_q = within.T
    part = np.repeat(np.arange(parts), count)
    fits = (q >= low_q[part]) & (p + k <= high_p[part]) & (q + k <= high_q[part])
    for j in range(k):
        at = np.flatnonzero(fits)
        fits[at] = mine[p[at] + j] == theirs[q[at] + j]
    good = np.logical_and.reduceat(fits, heads)
    # equal words from a match to the next
    step_p, step_q = np.diff(p), np.diff(q)
    inner = (part[1:] == part[:-1]) & good[part[1:]]
    near = (step_p == step_q) & (step_p <= k)
    more = np.where(near, step_p, k - np.maximum(0, k - np.minimum(step_p, step_q)))
    for i in np.flatnonzero(inner & (step_p > k) & (step_q > k)).tolist():
        more[i] += _common(mine[p[i] + k : p[i + 1]], theirs[q[i] + k : q[i + 1]])
    same = k + np.bincount(part[1:], np.where(inner, more, 0), parts).astype(np.int64)

    rows = np.flatnonzero(good)
    if not len(rows):
        return rows, np.zeros((0, 5), np.int64)
    ends = (heads + count - 1)[rows]
    p1, q1, p2, q2 = p[heads[rows]], q[heads[rows]], p[ends] + k, q[ends] + k
    same, size = same[rows], p2 - p1
    n_left = np.minimum(p1 - low_p[rows], q1 - low_q[rows])
    n_right = np.minimum(high_p[rows] - p2, high_q[rows] - q2)
    left, left_same = _extend(mine, theirs, p1 - 1, q1 - 1, n_left, -1)
    right, right_same = _extend(mine, theirs, p2, q2, n_right, 1)
    words = left + size + right
    short = np.flatnonzero((words < least) | (same + left_same + right_same < share * words))
    if len(short):
        sides = ((p1 - 1, q1 - 1, n_left, -1), (p2, q2, n_right, 1))
        around = [_equal(mine, theirs, x[short], y[short], n[short], step, AROUND)[0] for x, y, n, step in sides]
        # all equal words about some chains are too few
        enough = same[short] + around[0].sum(axis=1) + around[1].sum(axis=1) >= share * least
        short, around = short[enough], [x[enough] for x in around]
        before, after = _stops(around[0]), _stops(around[1])
        chosen = same[short] + before[1].max(axis=1) + after[1].max(axis=1) >= share * least
        short = short[chosen]
        before, after = ([x[chosen] for x in side] for side in (before, after))
        far = _longest(before, after, size[short], same[short], share)
        enough = far[:, 0] + size[short] + far[:, 2] >= least
        short = short[enough]
        left[short], left_same[short], right[short], right_same[short] = far[enough].T
    return rows, np.stack([p1 - left, p2 + right, q1 - left, q2 + right, same + left_same + right_same], axis=1)


class _Aligner:
    """Aligns the chains of many pairs of texts at once: those that wait, as soon as they have ``most`` matches."""

    def __init__(self, k: int, least: int, share: float, most: int = CHAINED):
        self.settings, self.share, self.most = (k, least, share), share, most
        self.waiting: list[tuple] = []
        self.matches = 0

    def add(
        self, mine: np.ndarray, theirs: np.ndarray, matches: np.ndarray, heads: np.ndarray | None, take: Callable
    ) -> None:
        """``take`` gets the spans that may count, in the order of their chains; matches without heads are chained."""
        self.waiting.append((mine, theirs, matches, heads, take))
        self.matches += len(matches)
        if self.matches >= self.most:
            self.flush()

    def flush(self) -> None:
        waiting, self.waiting, self.matches = self.waiting, [], 0
        if not waiting:
            return
        chained = iter(_parts_of_all([w[2] for w in waiting if w[3] is None], self.settings[0]))
        waiting = [w if w[3] is not None else (*w[:2], *next(chained), w[4]) for w in waiting]
        texts: list[np.ndarray] = []
        moved_p, size_p, end = [], [], 0
        for mine, *_ in waiting:  # a text that several chains in a row are of comes once
            if not texts or texts[-1] is not mine:
                texts.append(mine)
                end += len(mine)
            moved_p.append(end - len(mine))
            size_p.append(len(mine))
        size_q = [len(w[1]) for w in waiting]
        moved = np.stack([moved_p, np.cumsum(size_q) - size_q], axis=1)
        chains = [len(w[3]) for w in waiting]
        count = np.array([len(w[2]) for w in waiting])
        matches = np.concatenate([w[2] for w in waiting]) + np.repeat(moved, count, axis=0)
        heads = np.concatenate([w[3] for w in waiting]) + np.repeat(np.cumsum(count) - count, chains)
        within = np.stack([moved[:, 0], moved[:, 0] + size_p, moved[:, 1], moved[:, 1] + size_q], axis=1)
        found, good = _spans(
            np.concatenate(texts), np.concatenate([w[1] for w in waiting]), matches, heads, *self.settings,
            np.repeat(within, chains, axis=0),
        )
        words = found[:, 1] - found[:, 0]
        good &= (words >= LEAST_PART) & (found[:, 4] >= self.share * words)
        found -= np.repeat(np.pad(np.repeat(moved, 2, axis=1), ((0, 0), (0, 1))), chains, axis=0)
        edges = np.cumsum([0, *chains]).tolist()
        for (*_, take), low, high in zip(waiting, edges, edges[1:]):
            rows = np.flatnonzero(good[low:high])
            if len(rows):
                take(list(map(tuple, found[low + rows].tolist())))


def align(
    mine: np.ndarray, theirs: np.ndarray, path: np.ndarray, k: int = K,
    least: int = LEAST_WORDS, share: float = LEAST_SAME,
) -> tuple[int, int, int, int, int] | None:
    """``(start, end, source start, source end, equal words)`` of an aligned chain.

    A chain is extended as far as that gains; if it is too short then, as far as
    ``share`` of its words allows. None if a match of the chain does not stand in
    these texts.
    """
    return align_all(mine, theirs, path, np.zeros(1, np.int64), k, least, share)[0]


def accepted(spans: list[tuple], least: int, share: float) -> list[tuple]:
    """Spans ``(start, end, source start, source end, equal, source)`` that are long
    enough alone or with those that touch them."""
    good = sorted(s for s in spans if s[1] - s[0] >= LEAST_PART and s[4] >= share * (s[1] - s[0]))
    out: list[tuple] = []
    group: list[tuple] = []
    end = 0
    for span in [*good, None]:
        if group and (span is None or span[0] > end):
            if end - group[0][0] >= least:
                out += group
            group = []
        if span is not None:
            end = span[1] if not group else max(end, span[1])
            group.append(span)
    return out


def _adding(single: list[tuple], known: list[tuple]) -> list[tuple]:
    """Spans of single matches, less those of which all but a few words are in a known or longer one."""
    out: list[tuple] = []
    if not single:
        return out
    seen = np.zeros(max(s[1] for s in [*single, *known]), bool)
    for span in known:
        seen[span[0] : span[1]] = True
    for span in sorted(single, key=lambda s: (s[0] - s[1], s)):
        if np.count_nonzero(~seen[span[0] : span[1]]) >= LEAST_PART:
            out.append(span)
            seen[span[0] : span[1]] = True
    return out


def _codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), "<u4", len(words))


def _equal_runs(mine: np.ndarray, theirs: np.ndarray, least: int) -> tuple[np.ndarray, Callable[[int], int]]:
    """For each word, the end of the longest run of ``least`` or more words from there that stands in the other
    text too, else 0; and a function that gives its first place there.

    Runs of 1, 2, 4 ... words are ranked, each from the ranks of its halves; a word's longest run is shared with
    one of the two places of the other text that are next to it in the order of all that follows.
    """
    far, n = np.zeros(len(mine), np.int64), len(mine) + 1
    both = np.concatenate([mine, [2**32], theirs, [2**32 + 1]]).astype(np.int64)
    ranks = [np.unique(both, return_inverse=True)[1]]
    while ranks[-1].max() + 1 < len(both):
        half = 1 << (len(ranks) - 1)
        known = np.zeros(len(both), bool)
        known[ranks[-1][n:-1]] = True
        if 2 * half <= least and not known[ranks[-1][: n - 1]].any():
            return far, lambda i: 0
        rest = np.concatenate([ranks[-1][half:] + 1, np.zeros(min(half, len(both)), np.int64)])[: len(both)]
        ranks.append(np.unique(ranks[-1] * (len(both) + 1) + rest, return_inverse=True)[1])
    order = np.argsort(ranks[-1])
    turn, theirs_at = np.arange(len(both)), np.where(order >= n, np.arange(len(both)), -1)
    last = np.maximum.accumulate(theirs_at)
    following = np.minimum.accumulate(np.where(theirs_at < 0, len(both), theirs_at)[::-1])[::-1]
    here = order < n - 1
    for near in (last, following):
        pairs = turn[here & (near >= 0) & (near < len(both))]
        i, j = order[pairs], order[near[pairs]]
        start = i.copy()
        for level in range(len(ranks) - 1, -1, -1):
            go = (ranks[level][i] == ranks[level][j]).astype(np.int64) << level
            i, j = i + go, j + go
        far[start] = np.maximum(far[start], i)
    far[far - np.arange(len(mine)) < least] = 0

    def place(i: int) -> int:
        level = (int(far[i]) - i).bit_length() - 1
        other = int(far[i]) - i - (1 << level)
        starts = np.flatnonzero(ranks[level][n : len(both) - other] == ranks[level][i]) + n
        return int(starts[(ranks[level][starts + other] == ranks[level][i + other]).argmax()]) - n

    return far, place


def _places(text: str) -> tuple[list[int], list[int]]:
    """Where the words of a text start and end, in code points."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    inside = np.zeros(len(points) + 2, np.int8)
    inside[1:-1] = (points != 32) & ((points < 9) | (points > 13))
    step = np.diff(inside)
    return np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()


def _seeds_by_text(texts: list[str], k: int, window: int) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The codes of the words, and the hashes and places of the seeds, of each text."""
    kinds = list(dict.fromkeys(texts))
    if not kinds:
        return {}
    hashes, at, count = seeds_of_all(kinds, k, window)
    cuts = np.cumsum(count)[:-1]
    return {
        t: (_codes(words_of(t)), h, p) for t, h, p in zip(kinds, np.split(hashes, cuts), np.split(at, cuts))
    }


def compared(
    mine_text: str, theirs_text: str, k: int = K, window: int = WINDOW,
    least: int = LEAST_WORDS, share: float = LEAST_SAME, chained: int = CHAINED,
) -> list[tuple]:
    """Spans ``(start, end, source start, source end, equal words)`` of two texts, from all pairs of places.

    Runs of equal words come from a comparison at every shift; the fewest that cover all words
    in one are kept. The matches of seeds that are not deep inside those words are chained and
    aligned, all of them, ``chained`` or so at a time.
    """
    aligner = _Aligner(k, least, share, chained)
    seeds = _seeds_by_text([mine_text, theirs_text], k, window)
    finish = _compare(seeds[mine_text], seeds[theirs_text], aligner, chained)
    aligner.flush()
    return finish()


def _compare(
    mine_seeds: tuple[np.ndarray, ...], their_seeds: tuple[np.ndarray, ...], aligner: _Aligner, chained: int = CHAINED
) -> Callable[[], list[tuple]]:
    """Gives all chains of two texts to the aligner; returns what :func:`compared` returns once it has aligned them."""
    (mine, hashes, at), (theirs, other, there) = mine_seeds, their_seeds
    least = aligner.settings[1]
    far, place = _equal_runs(mine, theirs, least)
    spans: dict[tuple[int, int], tuple] = {}
    known = np.zeros(len(mine), bool)

    def take(found: list[tuple]) -> None:
        for span in found:
            spans.setdefault(span[:2], span)

    def widest() -> list[tuple]:
        out, reached = [], 0
        for span in sorted(spans.values(), key=lambda x: (x[0], -x[1])):
            if span[1] > reached:  # else it lies within another
                out.append(span)
                reached = span[1]
        return out

    best, reached = -1, 0
    for start in [*np.flatnonzero(far).tolist(), None]:
        # the run that reaches farthest of those that start within or right behind the last
        if best >= 0 and (start is None or start > reached):
            end = int(far[best])
            spans[best, end] = (best, end, place(best), place(best) + end - best, end - best)
            known[best:end] = True
            reached, best = end, -1
        if start is not None and far[start] > reached and (best < 0 or far[start] > far[best]):
            best = start
    order = np.argsort(other, kind="stable")
    other, there = other[order], there[order]
    low, high = np.searchsorted(other, hashes), np.searchsorted(other, hashes, "right")
    # a seed whose neighbourhood is known adds nothing
    total = np.r_[0, np.cumsum(~known)]
    around = LEAST_PART + aligner.settings[0]
    open_words = total[np.minimum(at + around, len(mine))] - total[np.maximum(at - LEAST_PART, 0)]
    wanted = np.flatnonzero((open_words > 0) & (high > low))
    counts = np.cumsum((high - low)[wanted])
    for block in np.split(wanted, np.flatnonzero(np.diff(counts // chained)) + 1):
        if not len(block):
            continue
        n = (high - low)[block]
        turn = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        matches = np.stack([np.repeat(at[block], n), there[np.repeat(low[block], n) + turn]], axis=1)
        aligner.add(mine, theirs, matches, None, take)
    return widest


def _batches(frame: pd.DataFrame, chars: int = AT_ONCE) -> list[pd.DataFrame]:
    """The rows in order, some ``chars`` characters at a time."""
    turn = (frame["text"].str.len().cumsum() // chars).to_numpy()
    edges = [0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), len(frame)]
    return [frame.iloc[i:j] for i, j in zip(edges, edges[1:]) if i < j]


def _named_in(filter_blocks, spark) -> Column:
    """A test whether an id may be among those of a filter of bounded size."""
    held = spark.sparkContext.broadcast(filter_blocks)

    @F.pandas_udf("boolean")
    def test(one: pd.Series, two: pd.Series) -> pd.Series:
        return pd.Series(maybe_listed(held.value, one.to_numpy(np.int64), two.to_numpy(np.int64)))

    key = F.col("doc_id").cast("string")
    return test(F.xxhash64(key), F.xxhash64(key, F.lit(1)))


def _filter_of(ids: DataFrame) -> np.ndarray:
    return build_filter(ids.select(F.col("id").cast("string").alias("key")))


def _chains(named: DataFrame, k: int, window: int) -> DataFrame:
    """``doc, source, path, begin, size``: chains of a document with a source, as packed
    places, and the words of the source about them."""

    def seed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for some in _batches(frame):
                parts = (seeds_of_all(x["text"].tolist(), k, window) for x in _batches(some, SEEDED))
                h, at, n = map(np.concatenate, zip(*parts))
                row = np.repeat(np.arange(len(some)), n)
                order = np.lexsort((h, row))  # a seed's places in a row of the table come together, in order
                h, at, row = h[order], at[order], row[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                first = np.flatnonzero(new)
                count = np.diff(np.append(first, len(h)))
                places = np.full(len(first), None, object)
                packed = at.astype("<i4")
                for i in np.flatnonzero(count > 1).tolist():
                    places[i] = packed[first[i] : first[i] + count[i]].tobytes()
                yield pd.DataFrame({
                    "h": h[first], "doc": some["doc_id"].to_numpy()[row[first]], "at": packed[first], "places": places,
                })

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            doc, source, path, begin, size = [], [], [], [], []
            for d, s, packed, repeated in zip(frame["doc"], frame["source"], frame["matches"], frame["repeated"]):
                if len(packed) == 1 and not len(repeated):
                    at, there = int(packed[0]) >> 32, int(packed[0]) & 0xFFFFFFFF
                    doc.append(d)
                    source.append(s)
                    path.append(struct.pack("<ii", at, there))
                    begin.append(max(0, there - AROUND))
                    size.append(there + k + AROUND - begin[-1])
                    continue
                packed = np.asarray(packed, np.int64)
                found = [np.stack([packed >> 32, packed & 0xFFFFFFFF], axis=1)]
                many = False
                for r in repeated:
                    here, there = (
                        np.frombuffer(x, "<i4").astype(np.int64) if x is not None else np.array([at], np.int64)
                        for x, at in ((r["places"], r["at"]), (r["theirs"], r["there"]))
                    )
                    if len(here) * len(there) > MOST_PAIRS:
                        many = True
                        break
                    found.append(pairs_of(here, there))
                if many:  # an empty path: the whole texts are compared
                    doc.append(d)
                    source.append(s)
                    path.append(b"")
                    begin.append(0)
                    size.append(2**31 - 1)
                    continue
                sure: list[tuple[int, int]] = []
                all_matches, heads = _all_parts(np.concatenate(found), k)
                step = np.diff(all_matches, axis=0)
                loose = np.r_[0, np.cumsum((step[:, 0] != step[:, 1]) | (step[:, 0] > k))]
                ends = np.r_[heads[1:], len(all_matches)] - 1
                exact = loose[ends] == loose[heads]
                wide = all_matches.astype("<i4")
                for low, high, (start, begin_there), (end, end_there), plain in zip(
                    heads.tolist(), ends.tolist(), all_matches[heads].tolist(), all_matches[ends].tolist(),
                    exact.tolist(),
                ):
                    end += k
                    # a better chain has these words as an exact passage already
                    if any(a <= start and end <= b for a, b in sure):
                        continue
                    if plain and end - start >= LEAST_WORDS:
                        sure.append((start, end))
                    # a part of one match too: aligning it tells whether it is a passage
                    doc.append(d)
                    source.append(s)
                    path.append(wide[low : high + 1].tobytes())
                    begin.append(max(0, begin_there - AROUND))
                    size.append(end_there + k + AROUND - begin[-1])
            yield pd.DataFrame({"doc": doc, "source": source, "path": path, "begin": begin, "size": size})

    spark = named.sparkSession
    path = scratch_path(spark, "chains")
    with job(spark):  # the seeds go once the chains are stored
        seeds = materialize(
            named.select("doc_id", "text").mapInPandas(seed, "h long, doc long, at int, places binary"), "seeds"
        )
        # stored, so that the join reads plain shuffles on both sides and hot seeds are split
        shared = materialize(
            seeds.groupBy("h").agg(F.min("doc").alias("source"), F.max("doc").alias("other"))
            .where("source <> other").select("h", "source"),
            "shared-seeds",
        )
        # few seeds are shared, so the hash tables are of those and the others are not sorted
        found = materialize(seeds.join(shared.hint("shuffle_hash"), "h"), "found-seeds")
        first = (
            found.where("doc = source").groupBy("h").agg(F.min(F.struct("at", "places")).alias("first"))
            .select("h", F.col("first.at").alias("there"), F.col("first.places").alias("theirs"))
        )
        several = F.col("places").isNotNull() | F.col("theirs").isNotNull()
        matches = found.where("doc <> source").join(materialize(first, "first-seeds"), "h").select(
            "doc", "source",
            F.when(
                ~several, F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("there").cast("long"))
            ).alias("m"),
            F.when(several, F.struct("at", "places", "there", "theirs")).alias("r"),
        )
        # a document's matches are at most its seeds
        paired = matches.groupBy("doc", "source").agg(
            F.collect_list("m").alias("matches"), F.collect_list("r").alias("repeated")
        )
        schema = "doc long, source long, path binary, begin int, size int"
        paired.mapInPandas(link, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def passages(
    docs: DataFrame, least: int = LEAST_WORDS, share: float = LEAST_SAME, k: int = K, window: int = WINDOW
) -> DataFrame:
    """A row for each passage of a document that stands in one with a smaller id.

    ``doc_id, start, end`` (words), ``start_char, end_char`` (code points),
    ``source_id, source_start, source_end``, ``n_same`` words, and ``text_key``, a
    hash that tells texts with one id apart.
    """
    spark = docs.sparkSession
    named = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    chains = _chains(named, k, window)
    sources = _filter_of(chains.select(F.col("source").alias("id")).distinct())
    owners = _filter_of(chains.select(F.col("doc").alias("id")).distinct())

    @F.pandas_udf("binary")
    def codes(texts: pd.Series) -> pd.Series:
        return pd.Series([_codes(words_of(t)).tobytes() for t in texts], dtype=object)

    texts_of_sources = named.where(_named_in(sources, spark)).select(
        F.col("doc_id").alias("source"), "text", codes("text").alias("codes")
    )
    # only the passage goes on, not the whole source for each of its chains, unless all of it is compared
    whole = F.length("path") == 0
    sliced = chains.join(texts_of_sources, "source").select(
        "doc", "source", "path", "begin", F.when(whole, F.col("text")).alias("whole"),
        F.when(~whole, F.substr("codes", F.col("begin") * 4 + 1, F.col("size") * 4)).alias("passage"),
    )
    # a document's chains are at most its seeds
    gathered = sliced.groupBy("doc").agg(
        F.collect_list(F.struct("source", "path", "begin", "whole", "passage")).alias("chains")
    )

    def aligned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in chain_items.from_iterable(map(_batches, frames)):
            rows, docs_here = [], []
            aligner = _Aligner(k, least, share)
            seeds = _seeds_by_text(
                [t for text, found in zip(some["text"], some["chains"]) for c in found if not c["path"]
                 for t in (text, c["whole"])], k, window,
            )
            for text, found in zip(some["text"], some["chains"]):
                spans, single, wholes = [], [], []
                docs_here.append((spans, single, wholes))
                mine = None
                for c in found:
                    if not c["path"]:
                        wholes.append((c["source"], _compare(seeds[text], seeds[c["whole"]], aligner)))
                        continue
                    if mine is None:
                        mine = _codes(words_of(text))
                    path = np.frombuffer(c["path"], "<i4").reshape(-1, 2).astype(np.int64)
                    path[:, 1] -= c["begin"]

                    def take(found, to=spans if len(path) > 1 else single, back=c["begin"], source=c["source"]):
                        to += [(s, e, s2 + back, e2 + back, same, source) for s, e, s2, e2, same in found]

                    aligner.add(mine, np.frombuffer(c["passage"], "<u4"), path, np.zeros(1, np.int64), take)
            aligner.flush()
            for doc_id, text, key, (spans, single, wholes) in zip(
                some["doc_id"], some["text"], some["text_key"], docs_here
            ):
                for source, finish in wholes:
                    spans += [(*x, source) for x in finish()]
                kept = accepted([*spans, *_adding(single, accepted(spans, least, share))], least, share)
                if kept:
                    starts, ends = _places(text)
                    rows += [
                        (doc_id, s, e, starts[s], ends[e - 1], source, s2, e2, same, key)
                        for s, e, s2, e2, same, source in kept
                    ]
            yield pd.DataFrame(rows, columns=[
                "doc_id", "start", "end", "start_char", "end_char", "source_id", "source_start",
                "source_end", "n_same", "text_key",
            ])

    mine = named.where(_named_in(owners, spark)).withColumn("text_key", F.xxhash64("text"))
    return mine.join(gathered, F.col("doc_id") == F.col("doc")).mapInPandas(
        aligned,
        "doc_id long, start int, end int, start_char int, end_char int, source_id long,"
        " source_start int, source_end int, n_same int, text_key long",
    )


@F.pandas_udf(StringType())
def _without(text: pd.Series, ranges: pd.Series) -> pd.Series:
    out = []
    for t, found in zip(text, ranges):
        at, kept = 0, []
        for s, e in sorted((int(r) >> 32, int(r) & 0xFFFFFFFF) for r in found):
            if s > at:
                kept.append(t[at:s])
            at = max(at, e)
        out.append("".join([*kept, t[at:]]).strip())
    return pd.Series(out)


# else a filter on its result is pushed below it, and texts are cut twice, in two workers a task
_without = _without.asNondeterministic()


def drop_passages(docs: DataFrame, **settings) -> DataFrame:
    """The documents without passages that one with a smaller id has, columns as they came.

    ``n_chars``, if there, is counted anew for changed texts. A document of which
    nothing is left goes.
    """
    spark = docs.sparkSession
    found = passages(docs, **settings).select(
        "doc_id", "text_key",
        F.shiftleft(F.col("start_char").cast("long"), 32).bitwiseOR(F.col("end_char").cast("long")).alias("r"),
    )
    ranges = materialize(
        found.groupBy("doc_id", "text_key").agg(F.collect_list("r").alias("ranges")), "ranges"
    )
    listed = _filter_of(ranges.select(F.col("doc_id").alias("id")).distinct())
    compared = F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    # the row travels in one column, so none of its names meets one of these
    rows = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    marked = rows.withColumn("maybe", F.when(compared, _named_in(listed, spark)).otherwise(False))
    joined = marked.where("maybe").withColumn("text_key", F.xxhash64("text")).join(
        ranges, ["doc_id", "text_key"], "left"
    )
    cut = joined.where("ranges IS NOT NULL").withColumn("text", _without("text", "ranges")).where("text <> ''")
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    kept = marked.where("NOT maybe").select("row").unionByName(joined.where("ranges IS NULL").select("row"))
    return kept.unionByName(cut.select(row.alias("row"))).select("row.*")
