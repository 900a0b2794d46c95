"""Line dedup: large band keys, long lines, documents of many lines, and recall of the banding."""

from __future__ import annotations

import random
import time

import pytest

from tests.llm import brute
from tickwise.llm import linededup


def similarity(a, b, n=linededup.SHINGLE_CHARS):
    x, y = ({t[i:i + n] for i in range(max(1, len(t) - n + 1))} for t in (a, b))
    return len(x & y) / len(x | y)


def lines_with_hot_keys():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    template = " ".join(word() for _ in range(12))
    lines = [f"{template} number {i}" for i in range(250)]  # one group of near copies
    long = " ".join(word() for _ in range(300))
    lines += [f"{long} {i}" for i in range(12)]
    lines += [" ".join(word() for _ in range(9)) for _ in range(60)]
    lines += [x[:-1] + "z" for x in lines[-30:]]
    rng.shuffle(lines)
    return lines


@pytest.mark.parametrize("limits,held", [({}, None), ({"group_lines": 8}, 64), ({"group_bytes": 5000}, 64)])
def test_groups_of_any_size_give_the_same_components(spark, monkeypatch, limits, held):
    if held:
        monkeypatch.setattr(linededup, "HELD_KEYS", held)
        monkeypatch.setattr(linededup, "BLOCK_KEYS", 500)
        monkeypatch.setattr(linededup, "LEAST_RANGES", 3)
    lines = lines_with_hot_keys()
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "k long, text string").repartition(4)
    sets = brute.Sets(range(len(lines)))
    for i, a in enumerate(lines):
        for j in range(i):
            if similarity(a, lines[j]) >= 0.8:
                sets.join(i, j)
    want = {}
    for i, x in enumerate(lines):
        want.setdefault(sets.root(i), set()).add(linededup.line_digest(x.encode()))
    got = {}
    for r in linededup.line_roots(docs, "text", **limits).collect():
        got.setdefault(bytes(r.root), set()).add(bytes(r.node))
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_a_document_of_many_lines_is_cut_in_linear_time(spark):
    n = 200_000
    row = [(1, "\n".join(map(str, range(n))), list(range(0, n, 2))), (2, None, None), (3, "a\nb", [0, 1]), (4, "a\nb", None)]
    start = time.time()
    rows = spark.createDataFrame(row, "k long, text string, gone array<int>")
    got = linededup.without_lines(rows, "text", "gone", "mask")
    assert {r.k: r.text for r in got.collect()} == {1: "\n".join(map(str, range(1, n, 2))), 2: None, 3: "", 4: "a\nb"}
    assert time.time() - start < 60


def test_sets_and_arrays_link_alike():
    lines = [x.encode() for x in lines_with_hot_keys()][:120] + ["é" * 9, "é" * 8 + "x", "ab", "ab c", ""]
    lines = [x if isinstance(x, bytes) else x.encode() for x in lines]

    def parts(edges):
        sets = brute.Sets(range(len(lines)))
        for a, b in edges:
            sets.join(a, b)
        return [sets.root(i) for i in range(len(lines))]
    assert parts(linededup._linked_sets(lines, 0.8)) == parts(linededup._linked_arrays(lines, 0.8))


def test_banding_finds_pairs_near_the_threshold():
    rng = random.Random(9)
    pairs = []
    while len(pairs) < 2000:
        a = "".join(rng.choice("abcdefghijklmnop ") for _ in range(rng.randint(30, 120)))
        b = list(a)
        for _ in range(rng.randint(1, 3)):
            b[rng.randrange(len(b))] = rng.choice("abcdefghijklmnop ")
        if 0.8 <= similarity(a, "".join(b)) < 0.85:
            pairs.append((a, "".join(b)))
    keys = linededup.band_keys([x.encode() for p in pairs for x in p])
    found = (keys[::2] == keys[1::2]).any(axis=1)
    assert found.mean() >= 0.95


def test_line_ids_tell_sizes():
    import numpy as np
    for n in (0, 1, 7, 8, 1000, 100_000):
        size = int(linededup.line_bytes(np.array([linededup.line_id(b"x" * n)], np.uint64))[0])
        assert n <= size <= max(1, 2 * n)
