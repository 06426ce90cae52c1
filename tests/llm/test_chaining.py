"""Repeated passages: planted ones, clean ones, and chains against a plain search."""

import random
import re

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import docs, prose, words
from voltide import session
from voltide.llm import chaining


def test_planted_passages_are_found_and_clean_ones_left(spark):
    rng = random.Random(2)
    passages = [words(n, 900 + n) for n in (51, 60, 90, 300)]
    rows, want = [], set()
    for k in range(60):
        text = words(rng.randrange(80, 400), k)
        if k >= 40:
            at = rng.randrange(len(text))
            text[at:at] = passages[k % 4]
            if k >= 44:
                want.add(k)
        rows.append((k, " ".join(text)))
    fuzzy = list(passages[3])
    for at in range(20, 300, 45):
        fuzzy[at] = "changed"
    rows.append((70, prose(100, 71) + " " + " ".join(fuzzy) + " " + prose(50, 72)))
    rows += [(80, rows[3][1]), (81, rows[3][1].upper()), (82, " ".join(passages[0][:40]) + " " + prose(60, 5000))]
    found = chaining.passages(docs(spark, rows, extra=True)).collect()
    assert {r["doc_id"] for r in found} == want | {70, 80, 81}
    texts = dict(rows)
    for r in found:
        assert r["source_id"] < r["doc_id"]
        mine = texts[r["doc_id"]][r["start_char"] : r["end_char"]].lower().split()
        assert mine == texts[r["doc_id"]].lower().split()[r["start"] : r["end"]]
        theirs = texts[r["source_id"]].lower().split()[r["source_start"] : r["source_end"]]
        assert len(mine) >= 50 and len(set(mine) & set(theirs)) >= 0.8 * len(set(mine))
    for k in want:
        passage = " ".join(passages[k % 4])
        spans = [texts[k][r["start_char"] : r["end_char"]] for r in found if r["doc_id"] == k]
        assert any(passage in s for s in spans)


def test_passages_are_cut(spark):
    passage = prose(70, 1)
    rows = [
        (1, prose(30, 2) + "\n" + passage + "\n" + prose(30, 3)), (2, prose(40, 4) + "\n" + passage),
        (3, passage), (4, prose(100, 5)), (None, passage), (5, None), (6, ""), (4, prose(100, 6)), (2, prose(40, 8)),
    ]
    df = docs(spark, rows, extra=True)
    out = chaining.drop_passages(df)
    assert out.columns == df.columns
    got = sorted((str(r["doc_id"]), str(r["text"]), r["n_chars"]) for r in out.collect())
    kept = [(i, t) for i, t in rows if i != 3]
    kept[1] = (2, prose(40, 4))
    assert got == sorted((str(i), str(t), None if t is None else len(t)) for i, t in kept)


def test_hot_passage_and_common_line(spark):
    passage, line = prose(60, 10), prose(12, 11)
    rows = [(k, f"{prose(60, 100 + k)}\n{line}\n" + (passage if k % 3 == 0 else "")) for k in range(120)]
    found = chaining.passages(docs(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(3, 120, 3))
    assert {r["source_id"] for r in found} == {0}


@pytest.mark.parametrize(("rate", "least"), [(0.05, 0.99), (0.1, 0.9), (0.2, 0.6)])
def test_passages_with_changed_words(spark, rate, least):
    rng, rows, count, n = random.Random(5), [], 100, 60
    for k in range(count):
        passage = words(n, 10_000 + k)
        changed = list(passage)
        for at in rng.sample(range(n), int(rate * n)):
            changed[at] = f"changed{k}x{at}"
        rows.append((k, f"{prose(90, 20_000 + k)} {' '.join(passage)} {prose(90, 30_000 + k)}"))
        rows.append((count + k, f"{prose(90, 40_000 + k)} {' '.join(changed)} {prose(90, 50_000 + k)}"))
    found = chaining.passages(docs(spark, rows)).collect()
    got = {(r["doc_id"], r["source_id"]) for r in found}
    assert got <= {(count + k, k) for k in range(count)}
    assert len(got) >= least * count
    for r in found:
        assert 80 <= r["start"] and r["end"] <= 90 + n + 10


def test_passages_of_repeated_units(spark):
    rows, want = [], {}
    for k, unit in enumerate((1, 2, 6, 10, 12, 16, 20)):
        passage = (words(unit, 60_000 + k) * 240)[:240]
        longer = (words(unit, 60_000 + k) * 600)[:600]
        rows.append((k, f"{prose(90, 61_000 + k)} {' '.join(passage)} {prose(90, 62_000 + k)}"))
        rows.append((100 + k, f"{prose(70, 63_000 + k)} {' '.join(passage)} {prose(90, 64_000 + k)}"))
        rows.append((200 + k, f"{prose(70, 65_000 + k)} {' '.join(longer)} {prose(90, 66_000 + k)}"))
        want |= {100 + k: set(range(70, 310)), 200 + k: set(range(70, 670))}
    got: dict[int, set] = {}
    for r in chaining.passages(docs(spark, rows)).collect():
        got.setdefault(r["doc_id"], set()).update(range(r["start"], r["end"]))
    assert set(got) == set(want)
    for k, whole in want.items():
        assert len(got[k] & whole) >= 0.98 * len(whole) and len(got[k] - whole) <= 10, k


def test_passages_of_lines_in_irregular_order(spark):
    """Every seed of the passage stands at many places of the source, and only one of them goes on as here."""
    rng = random.Random(8)
    lines = [words(12, 70_000 + k) for k in range(3)]
    order = [rng.randrange(3) for _ in range(300)]
    other = [rng.randrange(3) for _ in range(40)]
    source = [w for k in order for w in lines[k]]
    copy = [w for k in order[170:200] for w in lines[k]]
    rows = [
        (1, f"{prose(90, 71_000)} {' '.join(source)}"),
        (2, f"{prose(70, 72_000)} {' '.join(copy)} {prose(80, 73_000)}"),
        (3, f"{prose(70, 74_000)} {' '.join(lines[other[0]][:9])} {prose(80, 75_000)}"),
    ]
    found = chaining.passages(docs(spark, rows)).collect()
    assert {r["doc_id"] for r in found} == {2}
    assert max(r["end"] - r["start"] for r in found) >= len(copy)
    got = {w for r in found for w in range(r["start"], r["end"])}
    assert set(range(70, 70 + len(copy))) <= got and len(got) <= len(copy) + 10
    for r in found:
        assert r["source_id"] == 1 and r["n_same"] >= 0.8 * (r["end"] - r["start"])


def test_whole_comparison_in_blocks():
    rng = random.Random(9)
    lines = [words(9, 76_000 + k) for k in range(2)]
    texts = [" ".join(w for _ in range(60) for w in [*lines[rng.randrange(2)], str(rng.random())]) for _ in range(2)]
    texts[1] += " " + " ".join(texts[0].split()[100:180])

    def covered(**limit):
        return {w for s, e, *_ in chaining.compared(texts[0], texts[1], **limit) for w in range(s, e)}

    assert covered(chained=50) >= set(range(100, 180))
    assert covered() >= set(range(100, 180))


def test_empty_tables(spark):
    assert chaining.passages(docs(spark, [])).collect() == []
    assert chaining.passages(docs(spark, [(1, prose(80, 1)), (2, prose(80, 2))])).collect() == []
    assert chaining.drop_passages(docs(spark, [])).collect() == []


def plain_best(matches, gain, cost):
    best = {}
    for p, q in sorted(set(map(tuple, matches))):
        before = [best[m] - cost * (p - m[0] + q - m[1]) for m in best if m[0] < p and m[1] < q]
        best[p, q] = gain + max([0, *before])
    return max(best.values())


def test_chain_has_the_best_score():
    rng = np.random.default_rng(6)
    for _ in range(100):
        matches = rng.integers(0, 60, (rng.integers(1, 40), 2))
        paths = chaining.chain(matches)
        first = paths[0]
        assert (np.diff(first, axis=0) > 0).all()
        score = 8.0 * len(first) - 0.25 * np.abs(np.diff(first, axis=0)).sum()
        assert abs(score - plain_best(matches.tolist(), 8.0, 0.25)) < 1e-9
        assert sum(map(len, paths)) == len(np.unique(matches, axis=0))


def test_hashes_of_slices():
    rng = np.random.default_rng(12)
    text = rng.integers(33, 127, 3000).astype(np.uint8)
    starts = rng.integers(0, 2000, 400)
    ends = starts + rng.integers(0, 900, 400) % np.resize([7, 33, 70, 900], 400)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    got = chaining.hashes_of(padded, starts, ends).tolist()
    assert got == [xxhash.xxh64_intdigest(text[s:e].tobytes()) for s, e in zip(starts, ends)]


def test_seeds_of_several_texts_are_those_of_each():
    texts = ["", "a b", "a b c d e f", prose(9, 1), prose(300, 2), "x " * 40, " \t\n", prose(12, 3)]
    hashes, places, counts = chaining.seeds_of_all(texts)
    ends = np.cumsum(counts)
    for text, low, high in zip(texts, ends - counts, ends):
        words_here = text.encode().lower().split()
        runs = [xxhash.xxh64_intdigest(b" ".join(words_here[i : i + 6])) for i in range(len(words_here) - 5)]
        windows = [runs[i : i + 6] for i in range(max(len(runs) - 5, 1))] if runs else []
        want = sorted({i + w.index(min(w)) for i, w in enumerate(windows)})
        assert places[low:high].tolist() == want
        assert hashes[low:high].view(np.uint64).tolist() == [runs[i] for i in want]


def test_longest_runs_and_their_first_places():
    rng = np.random.default_rng(13)
    for size, least in ((1, 5), (2, 6), (3, 4), (40, 2)):
        for _ in range(20):
            mine, theirs = (rng.integers(0, size, rng.integers(0, 60)).astype(np.uint32) for _ in range(2))
            far, place = chaining._equal_runs(mine, theirs, least)
            for i in range(len(mine)):
                lengths = []
                for j in range(len(theirs)):
                    n = 0
                    while i + n < len(mine) and j + n < len(theirs) and mine[i + n] == theirs[j + n]:
                        n += 1
                    lengths.append(n)
                best = max(lengths, default=0)
                assert far[i] == (i + best if best >= least else 0)
                if far[i]:
                    assert place(i) == lengths.index(best)


def test_chains_aligned_at_once_are_as_one_by_one():
    rng = np.random.default_rng(14)
    mine = rng.integers(0, 3, 400).astype(np.uint32)
    theirs = np.where(rng.random(400) < 0.1, 99, mine).astype(np.uint32)
    places = [(i, j) for i in range(0, 395, 9) for j in range(395) if (mine[i : i + 6] == theirs[j : j + 6]).all()]
    paths = [part for whole in chaining.chain(np.array(places)) for part in chaining.parts_of(whole)]
    matches, heads = chaining._all_parts(np.array(places))
    assert [p.tolist() for p in np.split(matches, heads[1:])] == [p.tolist() for p in paths]
    assert len(paths) > 20
    assert chaining.align_all(mine, theirs, matches, heads) == [chaining.align(mine, theirs, p) for p in paths]


def test_lists_chained_together_are_as_one_by_one():
    rng = np.random.default_rng(15)
    for _ in range(60):
        lists = []
        for _ in range(rng.integers(1, 9)):
            matches = rng.integers(0, rng.integers(2, 80), (rng.integers(1, 200), 2))
            lists.append(np.unique(matches, axis=0))
        size = np.array([len(x) for x in lists])
        order, owner = chaining._linked_all(np.concatenate(lists), size)
        begin = 0
        for matches, (path, heads) in zip(lists, chaining._parts_of_all(lists)):
            here = slice(begin, begin + len(matches))
            plain = chaining._linked(*matches.T.tolist(), chaining.GAIN, chaining.GAP_COST)
            got = np.split(order[here] - begin, np.flatnonzero(np.diff(owner[here])) + 1)
            assert [x.tolist() for x in got] == plain
            want = chaining._all_parts(matches)
            assert path.tolist() == want[0].tolist() and heads.tolist() == want[1].tolist()
            begin += len(matches)


def test_pairs_aligned_together_are_as_one_by_one():
    rng = random.Random(16)
    lines = [words(9, 77_000 + k) for k in range(4)]
    texts = [" ".join(w for _ in range(40) for w in [*lines[rng.randrange(4)], str(rng.random())]) for _ in range(6)]
    seeds = chaining._seeds_by_text(texts, chaining.K, chaining.WINDOW)
    pairs = [(a, b) for a in texts for b in texts if a != b]
    aligner = chaining._Aligner(chaining.K, chaining.LEAST_WORDS, chaining.LEAST_SAME)
    later = [chaining._compare(seeds[a], seeds[b], aligner) for a, b in pairs]
    aligner.flush()
    got = [finish() for finish in later]
    assert got == [chaining.compared(a, b) for a, b in pairs] and sum(map(len, got)) > 20


def test_places_of_words():
    for text in ("", " ", "a", " a\tbc\n", "\u00a0x \U0001f600y\x0b\x1fz\x85 \r", prose(50, 1)):
        want = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        assert list(zip(*chaining._places(text))) == want


def test_longest_extension_is_that_of_all_pairs_of_lengths():
    rng = np.random.default_rng(17)
    left, right = (rng.random((80, 24)) < rng.random((80, 1)) for _ in range(2))
    size = rng.integers(6, 40, 80)
    sides = chaining._stops(left), chaining._stops(right)
    got = chaining._longest(*sides, size, size, 0.8)
    for row in range(80):
        best = (0, 0, 0, 0)
        for i in [0, *(n for n in range(2, 25) if left[row, n - 2 : n].all())]:
            for j in [0, *(n for n in range(2, 25) if right[row, n - 2 : n].all())]:
                same = left[row, :i].sum(), right[row, :j].sum()
                if size[row] + sum(same) >= 0.8 * (size[row] + i + j) and i + j > best[0] + best[2]:
                    best = (i, same[0], j, same[1])
        assert got[row].tolist() == list(best)


def test_only_the_chains_stay_in_the_shared_folder(spark):
    """The seeds, as large as the texts, are deleted before these are sent to be aligned."""
    folder = session.shared_folder(spark) + "/voltide"
    before = set(session.folder_names(spark, folder))
    found = chaining.passages(docs(spark, [(k, prose(80, 1)) for k in range(3)]))
    left = set(session.folder_names(spark, folder)) - before
    assert [name.rpartition("-")[0] for name in left] == ["chains"]
    assert sorted(r["doc_id"] for r in found.collect()) == [1, 2]


def test_extensions_past_many_words():
    rng = np.random.default_rng(18)
    mine = rng.integers(0, 30, 1500).astype(np.uint32)
    theirs = np.where(rng.random(1500) < 0.02, 99, mine).astype(np.uint32)
    at = rng.integers(0, 1500, 40)
    for step, n in ((1, 1500 - at), (-1, at + 1)):
        far, same = chaining._extend(mine, theirs, at, at, n, step)
        for start, words, equal, most in zip(at, far, same, n):
            total, best = 0, (0, 0, 0)
            for i, hit in enumerate((mine == theirs)[start::step][:most]):
                total += 1 if hit else -3
                best = max(best, (total, -i - 1, (total + 3 * (i + 1)) // 4))
                if best[0] - total > chaining.MOST_LOST:
                    break
            assert (words, equal) == (-best[1], best[2])


def test_passages_are_cut_once(spark):
    """A filter on the texts that are left does not cut them a second time, in workers of its own."""
    passage = " ".join(words(60, 4321))
    rows = [(1, prose(80, 1) + " " + passage), (2, prose(80, 2) + " " + passage), (3, passage), (4, None)]
    left = chaining.drop_passages(docs(spark, rows))
    assert left._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [_without(") == 1
    got = {r["doc_id"]: r["text"] for r in left.collect()}
    assert got == {1: rows[0][1], 2: prose(80, 2), 4: None}
