"""Components, shared keys, tiles and runs."""

import random

import numpy as np
import pyarrow as pa

from fathomseq.llm import linkage
from fathomseq.llm.common import Scratch, Words, pieces, runs, text_bytes


def test_components(spark):
    r = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 140)]
    hub = [(-5, i) for i in range(1000, 1060)]
    some = [(r.randrange(2000, 2060), r.randrange(2000, 2060)) for _ in range(45)]
    edges = chain + hub + some + [(7, 7), (None, 3), (4, None)] + chain[:3]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    got = linkage.connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()
    assert len(got) == len({x.id for x in got}) == len(up)
    assert {x.id: x.component for x in got} == {x: find(x) for x in up}
    assert linkage.connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0


def batches(rows, names, sizes):
    table = pa.table({n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(names)})
    at = 0
    for n in sizes:
        for b in table.slice(at, n).combine_chunks().to_batches() or [table.slice(0, 0).to_batches()[0] if table.slice(0, 0).to_batches() else pa.RecordBatch.from_pydict({x: pa.array([], pa.int64()) for x in names})]:
            yield b
        at += n


def test_runs_and_shared_keys_cross_batches():
    r = random.Random(2)
    rows = sorted((r.randrange(6), r.randrange(40)) for _ in range(52)) + [(9, 1), (9, 1), (11, 2), (12, 5), (12, 6), (12, 6), (12, 7), (13, 1)]
    for sizes in ([60], [1] * 60, [7, 0, 20, 33]):
        found = [(t.column("key")[0].as_py(), t.column("id").to_pylist()) for t in runs(batches(rows, ["key", "id"], sizes), "key")]
        assert found == [(k, [i for x, i in rows if x == k]) for k in sorted({k for k, _ in rows})]
        shared = [(a, b) for e in linkage.shared_keys(batches(rows, ["key", "id"], sizes)) for a, b in zip(*(c.to_pylist() for c in e.columns), strict=True)]
        many = [k for k, _ in sorted(set(rows))]
        assert shared == [(k, i) for k, i in sorted(set(rows)) if many.count(k) > 1]


def test_tiles_bring_every_pair_together(spark, monkeypatch):
    monkeypatch.setattr(linkage, "CHUNK_ROWS", 5)
    rows = [(1, i, 1) for i in range(17)] + [(2, i, 1) for i in range(100, 104)]
    tiled = linkage.tiles(spark.createDataFrame(rows, "cluster long, id long, units long"), "units").collect()
    by_tile = {}
    for r in tiled:
        by_tile.setdefault(r.tile, set()).add(r.id)
    for c, a, _ in rows:
        for d, b, _ in rows:
            assert any({a, b} <= s for s in by_tile.values()) == (c == d)


def test_words_against_regex():
    r = random.Random(3)
    texts = ["".join(r.choice("aB é\t\n|\x1c 漢") for _ in range(r.randrange(30))) for _ in range(80)] + ["", None]
    import re

    words = Words(*text_bytes(pa.array(texts)))
    found = [[bytes(words.raw[words.start[j] : words.end[j]]).decode() for j in range(words.first[i], words.first[i + 1])] for i in range(len(texts))]
    assert found == [re.findall("[^\x20\x09-\x0d]+", (t or "").replace("B", "b")) for t in texts]
    same = {}
    for words_of, i in zip(found, range(len(texts)), strict=True):
        for w, h in zip(words_of, words.hash[words.first[i] : words.first[i + 1]].tolist(), strict=True):
            assert same.setdefault(w, h) == h
    assert len(set(same.values())) == len(same)


def test_pieces_keep_all_rows():
    from fathomseq.llm import common

    texts = ["x" * n for n in (0, 10, common.PIECE * 2, 5, common.PIECE - 1, 3)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(6))], ["text", "n"])
    out = list(pieces(batch))
    assert [x for p in out for x in p.column("n").to_pylist()] == list(range(6)) and len(out) > 2
    shifted = list(pieces(batch.slice(1, 4)))
    assert [x for p in shifted for x in p.column("n").to_pylist()] == [1, 2, 3, 4]
    raw, at = text_bytes(shifted[0].column("text"))
    assert len(raw) == at[-1] and at[0] == 0 and np.all(raw == ord("x"))
