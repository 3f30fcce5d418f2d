"""Line deduplication and the n-gram Jaccard join against brute force."""

import random
import re

import numpy as np
import pytest

from fathomseq.llm.common import MARKS, PIECE, U64, Words, mix
from fathomseq.llm.line_dedup import all_within, dedup_lines, forest_of, near, normal, simhash, within
from fathomseq.llm.ngram_jaccard import jaccard_components, slice_keys

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], schema)


def groups(n, links):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in links:
        a, b = sorted((find(i), find(j)))
        up[b] = a
    return [find(i) for i in range(n)]


def varied(seed, words, lines):
    """Texts with exact copies, near copies and chains of edits."""
    r = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"Word{i}" for i in range(words)]
    out = []
    for _ in range(lines):
        base = [r.choice(vocabulary) for _ in range(r.choice([1, 2, 4, 12, 40, 90, 200]))]
        for _ in range(r.choice([1, 1, 2, 6])):
            out.append(" ".join(base))
            for _ in range(r.choice([0, 1, 1, 3])):
                base[r.randrange(len(base))] = r.choice(vocabulary)
    r.shuffle(out)
    return out


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_within_is_levenshtein():
    r = random.Random(4)
    for _ in range(400):
        a = "".join(r.choice("abé ") for _ in range(r.randrange(25)))
        b = list(a)
        for _ in range(r.randrange(6)):
            b[r.randrange(len(b) + 1) :][:1] = []
            b.insert(r.randrange(len(b) + 1), r.choice("abé "))
        b = "".join(b)
        d = distance(a, b)
        for most in (0, 1, 2, d - 1, d, d + 1):
            if most >= 0:
                assert within(a, b, most) == (d <= most)


def test_within_for_many():
    r = random.Random(5)
    for _ in range(40):
        a, b = [], []
        for _ in range(20):
            x = "".join(r.choice("abé ") for _ in range(r.randrange(1, 40)))
            y = list(x)
            for _ in range(r.randrange(8)):
                y[r.randrange(len(y) + 1) :][:1] = []
                y.insert(r.randrange(len(y) + 1), r.choice("abé "))
            a.append(x)
            b.append("".join(y)[r.randrange(3) :])
        most = np.array([r.randrange(8) for _ in a])
        assert all_within(a, b, most).tolist() == [within(x, y, int(m)) for x, y, m in zip(a, b, most, strict=True)]


def fp_near(x, y, a, b):
    """Near fingerprints for lines of the sizes a and b."""
    return bool(near(np.array([x], U64), np.array([y], U64), np.array([a]), np.array([b]), 90)[0])


@pytest.mark.parametrize("k", [3, 5])
def test_jaccard_against_brute_force(spark, k):
    texts = varied(11, 400, 150) + ["", None, " \t\n", "only", "ONLY", "two words", "two words "]
    got = {r[0]: tuple(r)[1:] for r in jaccard_components(frame(spark, enumerate(texts)), k, 90).collect()}
    sets = []
    for t in texts:
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOW))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])]
    assert len(links) > 60
    want = groups(len(sets), links)
    assert got == {i: (len(s), want[i]) for i, s in enumerate(sets)}


def test_jaccard_large_group_is_tiled(spark, monkeypatch):
    from fathomseq.llm import linkage

    monkeypatch.setattr(linkage, "CHUNK_ROWS", 8)
    r = random.Random(5)
    base = [f"v{i}" for i in range(120)]
    texts = []
    for _ in range(60):
        words = list(base)
        words[r.randrange(120)] = f"x{r.random()}"
        texts.append(" ".join(words))
    rows = jaccard_components(frame(spark, enumerate(texts)), 3, 90).collect()
    assert {r.component_id for r in rows} == {0}


@pytest.mark.parametrize("sizes", [(1073, 1129), (102_602, 107_891)])
def test_slices_do_not_depend_on_the_batch(sizes):
    sets = [np.sort(mix(np.arange(n).astype(U64) + U64(1))) for n in sizes]
    alone = [set(slice_keys(s, np.array([0, len(s)]), 90)[0].tolist()) for s in sets]
    keys, of = slice_keys(np.concatenate(sets), np.array([0, sizes[0], sum(sizes)]), 90)
    assert alone == [set(keys[of == i].tolist()) for i in (0, 1)]
    assert alone[0] & alone[1]


def test_jaccard_links_across_pieces(spark):
    long = [" ".join(f"word{i:015d}" for i in range(n + 2)) for n in (102_602, 107_891)]
    short = [" ".join(f"w{i}" for i in range(n + 2)) for n in (1073, 1129)]
    assert len(long[1]) > PIECE  # a batch of its own
    rows = [(1, short[0]), (2, long[0]), (3, short[1]), (4, long[1])]
    got = {r.doc_id: tuple(r)[1:] for r in jaccard_components(frame(spark, rows), 3, 90).collect()}
    assert got == {1: (1073, 1), 2: (102_602, 2), 3: (1129, 1), 4: (107_891, 2)}


def test_jaccard_edges(spark):
    rows = jaccard_components(frame(spark, [(7, "a b c d"), (3, "A b c d"), (None, "a b c d"), (5, ""), (3, "a b c d"), (9, None)]), 3, 90).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in rows) == [(-1, 2, None), (3, 2, 3), (3, 2, 3), (5, 0, 5), (7, 2, 3), (9, 0, 9)]
    assert jaccard_components(frame(spark, []), 3, 90).count() == 0
    extra = frame(spark, [(1, "a b c")]).selectExpr("*", "1 as id", "2 as cluster", "3 as component", "4 as n_shingles", "'z' as class_id")
    assert [tuple(r) for r in jaccard_components(extra, 3, 90).collect()] == [(1, 1, 1)]


def line_groups(lines):
    forms = [normal(x) for x in lines]
    fps = []
    for f in forms:
        raw = np.frombuffer(f.encode(), np.uint8)
        words = Words(raw, np.array([0, len(raw)]), MARKS)
        fps.append(int(simhash(words, words.first[:1], words.first[1:])[0]) if len(words.hash) else None)
    links = []
    for i in range(len(forms)):
        for j in range(i):
            if fps[i] is None or fps[j] is None:
                continue
            n = max(len(forms[i]), len(forms[j]))
            if forms[i] == forms[j] or (fp_near(fps[i], fps[j], len(forms[i]), len(forms[j])) and distance(forms[i], forms[j]) <= n * 10 // 100):
                links.append((j, i))
    return groups(len(forms), links), fps


def test_lines_against_brute_force(spark):
    r = random.Random(2)
    pool = [x for x in varied(3, 300, 60) if len(x) < 500]
    pool += [x.upper() + "!" for x in pool[:5]] + ["", "...", "  "]
    docs = ["\n".join(r.choice(pool) for _ in range(r.randrange(1, 6))) for _ in range(60)] + ["", None, "x\n", "\n\nx", "x"]
    out = {r.doc_id: r for r in dedup_lines(frame(spark, enumerate(docs))).collect()}
    lines = [(d, n, x) for d, t in enumerate(docs) if t is not None for n, x in enumerate(t.split("\n"))]
    group, fps = line_groups([x for *_, x in lines])
    first, want = {}, {d: [] for d in range(len(docs))}
    for (d, n, _), g, fp in zip(lines, group, fps, strict=True):
        if fp is not None and first.setdefault(g, (d, n)) != (d, n):
            want[d].append(n)
    assert sum(map(len, want.values())) > 50
    for d, t in enumerate(docs):
        assert out[d].removed_lines == want[d]
        assert out[d].n_lines == (0 if t is None else t.count("\n") + 1)
        assert out[d].text == (None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in want[d]))


def test_lines_recall_of_edit_similarity(spark):
    """Typos planted in real lines, and all their pairs of edit similarity 0.9, whatever their fingerprints."""
    r = random.Random(8)
    texts = [t.text for t in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").orderBy("doc_id").limit(300).collect()]
    lines = sorted({normal(x): x for t in texts if t for x in t.split("\n") if 10 <= len(normal(x)) < 400}.values())[:250]
    for x in list(lines):
        at = r.choice([i for i, c in enumerate(x) if c.isalnum()])
        lines.append(x[:at] + r.choice("bdxz") + x[at + 1 :])
    forms = [normal(x) for x in lines]
    links = [(j, i) for i in range(len(forms)) for j in range(i) if within(forms[i], forms[j], max(len(forms[i]), len(forms[j])) * 10 // 100)]
    assert len(links) >= 200
    want = groups(len(forms), links)
    removed = {x.doc_id for x in dedup_lines(frame(spark, enumerate(lines))).collect() if x.removed_lines}
    copies = {i for i, g in enumerate(want) if g != i}
    assert removed <= copies and len(removed) >= 0.97 * len(copies)


def test_line_recall_on_real_pairs(spark):
    """Of all pairs of different lines of a table with edit similarity 0.9, at least 0.9 are in one group."""
    texts = [t.text for t in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    lines = sorted({normal(x): x for t in texts if t for x in t.split("\n") if normal(x)}.values(), key=len)
    forms = [normal(x) for x in lines]
    counts = np.zeros((len(forms), 512), np.int32)  # an edit changes four counts of letter pairs at most
    for row, f in zip(counts, forms, strict=True):
        for a, b in zip(f[:-1], f[1:], strict=True):
            row[(ord(a) * 31 + ord(b)) % 512] += 1
    links, sizes = [], np.array([len(f) for f in forms])
    for i, f in enumerate(forms):
        most = np.maximum(sizes[:i], len(f)) // 10
        for j in np.flatnonzero((np.abs(sizes[:i] - len(f)) <= most) & (np.abs(counts[:i] - counts[i]).sum(1) <= 4 * most)).tolist():
            if within(f, forms[j], int(most[j])):
                links.append((j, i))
    want = groups(len(forms), links)
    copies = {i for i, g in enumerate(want) if g != i}
    removed = {x.doc_id for x in dedup_lines(frame(spark, enumerate(lines))).collect() if x.removed_lines}
    assert len(links) >= 40 and removed <= copies and len(removed) >= 0.9 * len(copies)


def test_long_runs_are_dealt_out(spark, monkeypatch):
    """A key of very many lines gives the same groups."""
    from fathomseq.llm import line_dedup

    r = random.Random(12)
    head = "the same three words begin all of these lines and "
    docs = [head + " ".join(r.choice("abcdefgh") * 3 + str(r.randrange(30)) for _ in range(6)) for _ in range(150)]
    docs += [x[:-1] + "z" for x in docs[:40]] + docs[:9]
    want = {x.doc_id: x.removed_lines for x in dedup_lines(frame(spark, enumerate(docs))).collect()}
    monkeypatch.setattr(line_dedup, "LONG_RUN", 20)
    assert {x.doc_id: x.removed_lines for x in dedup_lines(frame(spark, enumerate(docs))).collect()} == want
    assert sum(map(len, want.values())) >= 40


def test_line_edges(spark):
    long = " ".join(f"word{i}" for i in range(60_000))
    rows = [(1, "same line here"), (1, "same line here"), (None, "same line here"), (2, long), (3, long + "\nother thing")]
    out = sorted((r.doc_id or 0, r.removed_lines) for r in dedup_lines(frame(spark, rows)).collect())
    assert out == [(0, []), (1, [0]), (1, [0]), (2, []), (3, [0])]
    assert dedup_lines(frame(spark, [])).count() == 0
    clash = frame(spark, [(1, "a\nA")]).selectExpr("*", "7 as n_lines", "'q' as removed", "5 as row_key", "6 as id", "1 as doc")
    (row,) = dedup_lines(clash).collect()
    assert (row.text, row.n_lines, row.removed_lines, row.removed, row.row_key, row.id, row.doc) == ("a", 2, [1], "q", 5, 6, 1)


def test_forest_of_long_run():
    r = np.random.default_rng(1)
    fp = np.unique(r.integers(0, 1 << 63, 30).astype(np.uint64)[r.integers(0, 30, 400)] ^ (np.uint64(1) << r.integers(0, 64, 400).astype(np.uint64)))
    fp = np.concatenate([fp, fp[:50]])
    ids = np.arange(len(fp)) + 1000
    links = [(i, j) for i in range(len(fp)) for j in range(i) if fp_near(fp[i], fp[j], 0, 0)]
    edges = forest_of(ids, fp)
    assert len(edges) < len(ids)
    assert groups(len(ids), [(a - 1000, b - 1000) for a, b in edges.tolist()]) == groups(len(ids), links)


def test_lengths_are_not_mixed(monkeypatch):
    """Pairs of short and of long texts are not put into one table, whose size would be that of the longest for all."""
    from fathomseq.llm import line_dedup
    from fathomseq.llm.linkage import Forest

    cells = []

    def watched(a, b, most):
        cells.append(len(a) * (max(map(len, a)) + 2 * int(most.max())))
        return all_within(a, b, most)

    monkeypatch.setattr(line_dedup, "all_within", watched)
    r = random.Random(6)
    forms = ["".join(r.choice("abcdefgh") for _ in range(n)) for n in (20, 3000) for _ in range(400)]
    pairs = [(i, i + 1, len(forms[i]) // 10) for i in range(0, 800, 2)]
    assert not list(line_dedup.linked(forms, pairs, Forest(len(forms))))
    assert len(cells) >= 2 and max(cells) < 60 * 3600


def test_letters_lose_no_link():
    from fathomseq.llm.line_dedup import able, forest_of, lengths, letter_marks

    r = random.Random(7)
    lines = []
    for _ in range(300):
        x = [r.choice("abcdexyzé漢 ") for _ in range(r.randrange(4, 700))]
        lines.append("a" + "".join(x))
        for _ in range(len(x) // 10):
            x[r.randrange(len(x))] = r.choice(["", "é", "漢", "e", "qq"])
        lines.append("a" + "".join(x))
    raw = [x.encode() for x in lines]
    words = Words(np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(x) for x in raw])), MARKS)
    first, last = words.first[:-1], words.first[1:]
    size = lengths(words, first, last)
    marks = letter_marks(words, first, last, size)
    forms = [normal(x) for x in lines]
    near_by = [i for i in range(0, len(lines), 2) if within(forms[i], forms[i + 1], max(size[i], size[i + 1]) * 10 // 100)]
    assert len(near_by) > 50
    both = np.array(near_by)
    assert able(marks[both], marks[both + 1], np.maximum(size[both], size[both + 1]), 90).all()
    unlike = np.array([[i, j] for i in range(0, 100, 2) for j in range(i + 2, 100, 2) if abs(size[i] - size[j]) < 20 and size[i] < 100])
    assert not able(marks[unlike[:, 0]], marks[unlike[:, 1]], size[unlike].max(1), 90).all()
    own = np.array([[1, 2], [1, 2], [0x0A0A0A0A, 2]])
    assert forest_of(np.array([5, 6, 7]), np.zeros(3, U64), np.array([30, 30, 30]), 90, own).tolist() == [[5, 6]]
