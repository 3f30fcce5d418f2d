"""URL filters, fixity audit, bit-sliced search, rollups and mixing against brute force, and their odd rows."""

import gzip
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomseq.llm import bitsliced, rollups, urlfilter, warc
from fathomseq.llm.common import Scratch
from fathomseq.llm.mixing import mix, plan


def test_cascade_is_exact(spark):
    r = random.Random(1)
    keys = spark.createDataFrame([(f"k{i}",) for i in range(3000)], "key string")
    for n in (0, 1, 40, 1500, 3000):
        listed = sorted(r.sample(range(3000), n))
        hashed = keys.select("key", *urlfilter.key_hashes(F.col("key")))
        chosen = hashed.where(F.col("key").isin([f"k{i}" for i in listed]))
        cascade = urlfilter.Cascade.of(chosen, hashed, Scratch(spark))
        rows = hashed.toPandas()
        said = cascade.listed(rows.h1.to_numpy().view(np.uint64), rows.h2.to_numpy().view(np.uint64))
        assert set(rows.key[said]) == {f"k{i}" for i in listed}
        assert n in (0, 1, 3000) or len(cascade.levels) > 1


def judged(url, rules, hosts):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    inside = lambda h: host == h or host.endswith("." + h)
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if inside(h) and path.startswith(p)]
    listed = any(inside(h) for h in hosts)
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "block" if listed else "allow", listed


@pytest.mark.parametrize("shard_keys", [4_000_000, 3])
def test_judge(spark, monkeypatch, shard_keys):
    monkeypatch.setattr(urlfilter, "SHARD_KEYS", shard_keys)
    monkeypatch.setattr(urlfilter, "SHARDS_AT_ONCE", 2)
    rules = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("a.org", "", "block"), ("b.org", "/x", "allow"), ("b.org", "/x", "block"), ("é.org", "/é", "block")]
    hosts = ["bad.com", "org", "evil.example.net"]
    r = random.Random(6)
    urls = [f"{r.choice(['http', 'https', ''])}://{'.'.join(r.sample(['www', 'bad', 'evil', 'a', 'b', 'é'], r.randrange(3)) + [r.choice(['example', 'Example', 'a', 'b'])] + [r.choice(['com', 'NET', 'org'])])}{r.choice(['', '/', '/en/', '/en/7', '/de/85', '/x?y', '#/en/', '?q=/en/', '/é/'])}" for _ in range(150)]
    urls += [None, "", "no-scheme.com/en/", "http://", "://x.com/en/1", "http://x.com/en/a://b.net/de/", "http://" + "y" * 50_000 + ".com/en/" + "z" * 50_000, "http://..com/en/"]
    pages = spark.createDataFrame([(i if i != 3 else None, u, "h", "r", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, rule string, keys int")
    frame = spark.createDataFrame(rules + [(None, "/", "block"), ("z", "/", "maybe")], "host string, path string, verdict string")
    listed = spark.createDataFrame([(h,) for h in [*hosts, None]], "host string")
    got = {r.page_id: tuple(r)[1:] for r in urlfilter.judge(pages, frame, listed).collect()}
    assert got == {(i if i != 3 else None): judged(u, rules, hosts) for i, u in enumerate(urls)}
    if shard_keys > 3:
        assert urlfilter.judge(pages.limit(0), frame, listed).count() == 0
        assert {r.verdict for r in urlfilter.judge(pages, frame.limit(0), listed.limit(0)).collect()} == {"allow"}


def test_warc_audit(spark, tmp_path):
    r = random.Random(2)
    pages = [(i, f"http://x.org/{i}", "é" * r.randrange(4000)) for i in range(120)] + [(7, "http://x.org/7", "again"), (None, None, None), (200, "", "")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("file", F.lit("f"))
    ours = warc.records(frame, 3).cache()
    rows = [tuple(x) for x in ours.collect()]
    assert len(rows) == len(pages)
    theirs = [(f, o, n, d if i % 9 else "0" * 64, p, u) for i, (f, o, n, d, p, u) in enumerate(rows) if i % 13]
    theirs.append((2, 10_000_000, 5, "ab", 999, "new"))
    replica = spark.createDataFrame(theirs, ours.schema)
    a, b = ({(str(f), o): d for f, o, n, d, *_ in x} for x in (rows, theirs))
    want = {(k, "missing" if k not in b else "extra" if k not in a else "changed") for k in a.keys() | b.keys() if a.get(k) != b.get(k)}
    for fanout, size in ((16, 1 << 16), (2, 512)):
        assert {((x.file, x.offset), x.damage) for x in warc.audit(ours, replica, fanout, size).collect()} == want
    assert warc.audit(ours, ours).count() == 0
    assert warc.audit(ours, ours.limit(0)).count() == len(a)
    assert warc.audit(ours.limit(0), ours.limit(0)).count() == 0

    # real replicas: a lost record and an altered one, found though all that follow have moved
    rows = warc.layout(frame, 2)
    lost, altered = F.col("page_id") == 30, F.col("page_id").isin(11, 40, 41)
    spoilt = rows.where(~F.coalesce(lost, F.lit(False))).withColumn("record", F.when(altered, F.concat("record", F.lit(b"\0"))).otherwise(F.col("record")))
    got = warc.audit(ours := warc.hashed(rows), warc.hashed(spoilt), 4, 1024)
    assert sorted((x.page_id, x.damage) for x in got.collect()) == [(11, "changed"), (30, "missing"), (40, "changed"), (41, "changed")]
    assert {(x.page_id, x.offset) for x in got.collect()} <= {(x.page_id, x.offset) for x in ours.collect()}
    assert sorted((x.page_id, x.damage) for x in warc.audit(warc.hashed(spoilt), ours).collect()) == [(11, "changed"), (30, "extra"), (40, "changed"), (41, "changed")]

    one = frame.where("page_id < 50").coalesce(1)
    warc.write_warc(one, str(tmp_path / "w"))
    again = warc.read_warc(spark, str(tmp_path / "w" / "part-*")).collect()
    assert sorted(x.digest for x in again) == sorted(x.digest for x in warc.records(one, 1).collect())
    assert Counter(x.url for x in again) == Counter(x.url for x in one.collect())

    # files: plain, one gzip member for each record, and a replica with a spoilt byte and a lost record
    content = next((tmp_path / "w").glob("part-*")).read_bytes()
    cut = sorted(x.offset for x in again) + [len(content)]
    parts = [content[a:b] for a, b in zip(cut, cut[1:])]
    for folder, kept in (("plain", parts), ("zipped", [gzip.compress(x) for x in parts]), ("spoilt", [*parts[:9], parts[10], parts[11][:-9] + b"?" + parts[11][-8:], *parts[12:]])):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a").write_bytes(b"".join(kept))
    whole, zipped, spoilt = (warc.read_warc(spark, str(tmp_path / f / "a")).withColumn("file", F.lit("a")) for f in ("plain", "zipped", "spoilt"))
    assert warc.audit(whole, zipped, 4, 256).count() == 0
    found = {(x.offset, x.damage) for x in warc.audit(whole, spoilt, 4, 256).collect()}
    assert found == {(cut[9], "missing"), (cut[11], "changed")}


def test_top_products(spark, monkeypatch):
    monkeypatch.setattr(bitsliced, "BLOCK_ROWS", 70)
    r = np.random.default_rng(4)
    rows = [(i, r.normal(0, 0.5, 9).round(2).tolist()) for i in range(300)]
    rows += [(i, rows[50][1]) for i in range(300, 340)]  # ties
    rows += [(340, None), (341, [None] * 9), (342, [float("nan")] * 9), (343, [float("inf")] + [0.0] * 8), (None, rows[1][1]), (350, [0.0] * 9), (351, [1.0, 2.0]), (360, [1.0, -2.0]), (361, []), (0, rows[0][1])]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, rank int, query_id string")
    clean = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            clean[i] = [int(np.floor(256 * float(np.float32(x)))) for x in v]
    want = []
    for q, v in clean.items():
        if q % 10 == 0:
            scores = sorted((-int(np.dot(v, w)), i) for i, w in clean.items() if i != q and len(w) == len(v))
            want += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:5], 1)]
    for joined in ("true", "false"):  # small shuffles in one task, and in as many as a large table has
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", joined)
        assert sorted(map(tuple, bitsliced.top_products(frame, 10).collect())) == sorted(want)
    assert bitsliced.top_products(frame.limit(0), 10).count() == 0


def test_top_products_of_large_components(spark):
    """Sums within a long are exact; those beyond are the nearest long and rank by their true value."""
    rows = [(10, [1e10, 1.0]), (1, [1e10, 2.0]), (2, [1e10, 1.0]), (3, [-1e10, 1.0]), (4, [1e18, 0.0]), (20, [2.0**24, 1.0]), (5, [2.0**22, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): (r["rank"], r.score) for r in bitsliced.top_products(frame, 10, k=10).collect()}
    ends = {i: [min(max(int(np.floor(256 * x)), -(2**63)), 2**63 - 1) for x in v] for i, v in rows}
    for q in (10, 20):
        for i in ends:
            if i != q:
                true = sum(a * b for a, b in zip(ends[q], ends[i], strict=True))
                assert got[q, i][1] == min(max(true, -(2**63)), 2**63 - 1)
        assert sorted(r for (a, _), (r, _) in got.items() if a == q) == [1, 2, 3, 4, 5, 6]


def test_bit_slices_beyond_a_long():
    values = np.array([[1 << 41, 1], [5, 1 << 41], [-(1 << 62), 7], [(1 << 63) - 1, -(1 << 63)]], np.int64)
    index = bitsliced.BitSlices(values)
    for query in values:
        scores = [sum(a * b for a, b in zip(row, query.tolist(), strict=True)) for row in values.tolist()]
        assert set(index.top(query, 2, index.full).tolist()) == set(sorted(range(4), key=lambda i: -scores[i])[:2])


def test_bit_slices_of_large_numbers():
    r = np.random.default_rng(5)
    values = r.integers(-(1 << 25), 1 << 25, (130, 4))
    index = bitsliced.BitSlices(values)
    for query in r.integers(-(1 << 25), 1 << 25, (20, 4)):
        best = index.top(query, 7, index.full)
        order = np.lexsort((np.arange(130), -(values @ query)))
        assert set(best.tolist()) == set(order[:7].tolist())


def test_rollups(spark, tmp_path):
    store = rollups.TokenRollups(spark, f"file://{tmp_path}/r")
    assert store.totals().count() == 0
    rows = spark.createDataFrame([(1, "a b", "s", "en", 2), (2, "c", None, "de", 1), (3, None, "s", "en", None)], "doc_id long, text string, source string, lang string, tokens long")
    assert store.commit("b1", rollups.signed(rows, 1, "v1"))
    assert not store.commit("b1", rollups.signed(rows, 1, "v1"))
    assert store.commit("b2", rollups.revised(rows.where("doc_id = 1").withColumn("new", F.lit(5)), "v1", "v2", "tokens", "new"))
    assert store.commit("b3", rollups.signed(rows.where("doc_id = 2"), -1, "v1"))
    again = rollups.TokenRollups(spark, f"file://{tmp_path}/r")
    assert again.committed() == ["b1", "b2", "b3"]
    assert sorted(map(tuple, again.totals().collect())) == [("s", "en", "v1", 1, 0), ("s", "en", "v2", 1, 5)]
    # a snapshot holds the totals; later batches are added to it
    assert store.compact() and not store.compact()
    assert sorted(map(tuple, again.totals().collect())) == [("s", "en", "v1", 1, 0), ("s", "en", "v2", 1, 5)]
    small = rollups.TokenRollups(spark, f"file://{tmp_path}/r", compact_every=1)
    assert small.commit("b4", rollups.signed(rows, 1, "v1")) and small._state()[1] == []
    assert not small.commit("b2", rollups.signed(rows, 1, "v1"))
    assert sorted(map(tuple, again.totals().collect()), key=str) == sorted([("s", "en", "v1", 3, 2), ("s", "en", "v2", 1, 5), (None, "de", "v1", 1, 1)], key=str)
    with pytest.raises(ValueError):
        store.commit("../x", rollups.signed(rows, 1, "v1"))


def test_rollups_of_two_writers(spark, tmp_path, monkeypatch):
    """Both find the batch free and write; one counts, and the other's data goes."""
    rows = spark.createDataFrame([("s", "en", 2)], "source string, lang string, tokens long")
    first, second = (rollups.TokenRollups(spark, f"file://{tmp_path}/r") for _ in range(2))
    write = rollups.TokenRollups._write

    def late(self, *args, **more):
        if self is first:
            assert second.commit("b", rollups.signed(rows, 1, "v"))
        return write(self, *args, **more)

    monkeypatch.setattr(rollups.TokenRollups, "_write", late)
    assert not first.commit("b", rollups.signed(rows, 1, "v"))
    assert [tuple(r) for r in first.totals().collect()] == [("s", "en", "v", 1, 2)]
    assert len(list((tmp_path / "r" / "data").iterdir())) == 1 and not [p for p in (tmp_path / "r" / "staging").iterdir() if p.suffix != ".crc"]


def test_rollup_query_of_odd_rows(spark, tmp_path):
    """Repeated and null ids, null texts, repeated rows and empty tables."""
    from fathomseq.llm.queries import op7_token_rollups

    rows = [(1, "s", "en", "one two"), (1, "s", "en", "one two"), (1, "s", "de", "drei"), (None, "s", "de", "vier"), (None, "s", "de", "vier"), (None, None, None, None), (5, "s", "en", None), (6, "s", "en", None), (7, "t", "de", "vier"), (8, "s", "en", "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    n = {}
    for name in ("byte_bpe_50k", "byte_bpe_multi_50k"):
        n[name] = {r.text: r.tokens for r in rollups.count_tokens(docs.select("text", F.col("text").alias("same")), name).withColumnRenamed("same", "text").collect()}
    one, many = n["byte_bpe_50k"], n["byte_bpe_multi_50k"]
    want = {("s", "en", "byte_bpe_50k", 4, one["one two"]), ("s", "de", "byte_bpe_multi_50k", 1, many["drei"]), ("t", "de", "byte_bpe_multi_50k", 1, many["vier"]), (None, None, "byte_bpe_multi_50k", 1, 0)}
    assert {(r.source, r.lang, r.tokenizer, r.docs, r.tokens) for r in op7_token_rollups(spark, str(tmp_path)).collect()} == want
    (tmp_path / "none").mkdir()
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert op7_token_rollups(spark, str(tmp_path / "none")).count() == 0


def test_token_counts(spark):
    import base64

    import tiktoken

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "source", "text", F.lit("x").alias("tokens"))
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(f"{rollups.VOCABULARIES}/byte_bpe_50k.tiktoken", "rb"))}
    encoding = tiktoken.Encoding("t", pat_str=rollups.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r.tokens for r in rollups.count_tokens(docs, "byte_bpe_50k").collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got == {i: len(encoding.encode_ordinary(t)) for i, t in texts.items()}
    assert all(encoding.decode(encoding.encode_ordinary(t)) == t for t in texts.values())


def test_rollup_query_against_recount(spark):
    from fathomseq.llm.queries import op7_token_rollups

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counts = {}
    for name in ("byte_bpe_50k", "byte_bpe_multi_50k"):
        counts[name] = {r.doc_id: r.tokens for r in rollups.count_tokens(docs.select("doc_id", "text"), name).collect()}
    seen, want = set(), Counter()
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        if r.text not in seen:
            seen.add(r.text)
            name = "byte_bpe_50k" if r.lang == "en" else "byte_bpe_multi_50k"
            want[r.source, r.lang, name, "docs"] += 1
            want[r.source, r.lang, name, "tokens"] += counts[name][r.doc_id]
    got = Counter()
    for r in op7_token_rollups(spark, "/root/testdata/sf0.01").collect():
        got[r.source, r.lang, r.tokenizer, "docs"], got[r.source, r.lang, r.tokenizer, "tokens"] = r.docs, r.tokens
    assert got == want


def filled(sizes, weights, epochs):
    """Water-filling by rounds, as fractions."""
    from fractions import Fraction

    target, capped, total = {}, set(), sum(sizes.values())
    while True:
        left = total - sum(epochs * sizes[s] for s in capped)
        free = [s for s in sizes if s not in capped]
        share = sum(weights[s] for s in free)
        target = {s: epochs * sizes[s] if s in capped else Fraction(left * weights[s], share) for s in sizes}
        over = {s for s in free if target[s] > epochs * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mixing(spark):
    r = random.Random(7)
    for n_sources, epochs in ((1, 3), (5, 3), (9, 2)):
        names = [None, "é", "", "a", "B", "b", "zz", "10", "9"][:n_sources]
        rows = [(i, " w" * r.randrange(30), r.choice(names)) for i in range(400)]
        rows += [(400 + i, "x " * r.randrange(3), names[-1]) for i in range(3)] + [(500, None, names[0]), (None, "a b", names[0]), (0, *rows[0][1:])]
        frame = spark.createDataFrame([(*x, 1, "c") for x in rows], "doc_id long, text string, source string, size int, copy string").repartition(3)
        out = plan(frame, epochs=epochs).collect()
        sizes = Counter()
        for _, t, s in rows:
            sizes[s] += len((t or "").split())
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        want = filled(sizes, {s: i % 3 + 1 for i, s in enumerate(order)}, epochs)
        assert len(out) == len(rows)
        taken = Counter()
        for x in out:
            assert x.source_size == sizes[x.doc.source] and abs(x.target - float(want[x.doc.source])) < 1e-6
            assert x.taken == x.copies * x.size <= epochs * x.size
            taken[x.doc.source] += x.taken
        assert all(abs(taken[s] - want[s]) <= 31 for s in sizes)
        assert sorted(map(str, plan(frame.repartition(7), epochs=epochs).collect())) == sorted(map(str, out))
        mixed = mix(frame, epochs=epochs)
        assert mixed.columns == ["doc_id", "text", "source", "size", "copy"]
        assert mixed.count() == sum(x.copies for x in out)
    assert plan(frame.limit(0)).count() == 0
    assert mix(spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")).count() in (0, 1)
