"""Greedy string tiling and decontamination against brute force."""

import random

import numpy as np

from fathomseq.llm.common import U64
from fathomseq.llm.decontaminate import decontaminate, leaks, tile, tile_by_length

DOCS = "doc_id long, text string, extra int, row_key string"
LETTERS = "".join(chr(b) if chr(b).isalnum() else " " for b in range(128))


def naive_tiles(a, b, least):
    """The covered lengths by the textbook's loop over all pairs of positions."""
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return out
        out.append((i, j, n))
        for k in range(n):
            free_a[i + k] = free_b[j + k] = False


def test_tiles():
    r = random.Random(3)
    for _ in range(150):
        a, b = ([r.randrange(3) for _ in range(r.randrange(30))] for _ in range(2))
        got = tile(np.array(a, U64), np.array(b, U64), 3)
        want = naive_tiles(a, b, 3)
        assert max([0, *(n for *_, n in got)]) == max([0, *(n for *_, n in want)])
        used_a, used_b = set(), set()
        for x, y, n in got:
            assert n >= 3 and a[x : x + n] == b[y : y + n]
            assert not used_a & set(range(x, x + n)) and not used_b & set(range(y, y + n))
            used_a |= set(range(x, x + n))
            used_b |= set(range(y, y + n))
        # nothing of three tokens is left that could still be marked
        for x in range(len(a) - 2):
            for y in range(len(b) - 2):
                assert a[x : x + 3] != b[y : y + 3] or used_a & {x, x + 1, x + 2} or used_b & {y, y + 1, y + 2}


def test_tiles_of_repetitive_texts():
    r = random.Random(4)
    for _ in range(80):
        a, b = (np.array([r.randrange(2) for _ in range(r.randrange(40))], U64) for _ in range(2))
        covered = [sum(n for *_, n in t) for t in (tile(a, b, 3), tile_by_length(a, b, 3))] if len(a) >= 3 and len(b) >= 3 else [0, 0]
        longest = [max([0, *(n for *_, n in t)]) for t in (tile(a, b, 3), tile_by_length(a, b, 3))] if len(a) >= 3 and len(b) >= 3 else [0, 0]
        assert longest[0] == longest[1] and abs(covered[0] - covered[1]) <= 6  # ties may be cut differently
    same = np.zeros(20_000, U64)
    assert tile(same, same, 5) == [(0, 0, 20_000)]


def words(text):
    return "".join(LETTERS[ord(c)] if ord(c) < 128 else c for c in (text or "")).lower().split()


def test_leaks_against_brute_force(spark):
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(200)] + ["Über", "été"]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(n))) for i, n in enumerate([3, 5, 14, 30, 59, 30, 1, 4])] + [(8, ", ; !"), (9, ""), (10, None), (None, "alpha beta gamma delta epsilon zeta")]
    docs = []
    for n in range(60):
        text = [r.choice(vocabulary) for _ in range(r.choice([0, 3, 50, 300]))]
        part = r.choice(items)[1]
        if part and n % 3:
            part = part.split()
            if n % 2:  # reordered
                cut = r.randrange(len(part))
                part = part[cut:] + ["between", "them"] + part[:cut]
            if n % 5 == 0:
                part[len(part) // 2] = "changed"
            at = r.randrange(len(text) + 1)
            text[at:at] = part
        docs.append((n, " ".join(text).upper() if n % 7 == 0 else ", ".join(text), n, "k"))
    docs += [(100, None, 1, None), (101, "", 1, None), (None, "ALPHA beta, gamma! delta epsilon zeta", 1, None), (5, docs[5][1], 1, None), (102, f"before, {items[7][1]}. After", 1, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, DOCS)
    got = {(x.doc_id, x.item_id): (x.n_tokens, x.covered) for x in leaks(frame, bench).collect()}
    want = {}
    for d, text, *_ in docs:
        for i, item in items:
            t = words(item)
            share = sum(n for *_, n in tile(np.array([hash(x) & 2**63 - 1 for x in words(text)], U64), np.array([hash(x) & 2**63 - 1 for x in t], U64), min(5, len(t)))) if t else 0
            if t and share >= 0.5 * len(t):
                want[d, i] = len(t), share
    assert got == want and len(want) > 15 and {1, 3, 4} <= {n for n, _ in want.values()}
    clean = decontaminate(frame, bench)
    assert clean.columns == frame.columns
    assert sorted((-1 if x.doc_id is None else x.doc_id for x in clean.collect())) == sorted(d if d is not None else -1 for d, *_ in docs if d not in {a for a, _ in want})


def test_empty(spark):
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    none = spark.createDataFrame([], DOCS)
    assert leaks(none, bench).count() == 0
    assert leaks(spark.createDataFrame([(1, "a b c d e f", 1, "")], DOCS), bench.limit(0)).count() == 0
