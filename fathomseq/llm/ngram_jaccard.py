"""N-gram Jaccard join by parity sketches.

Each distinct word shingle flips one bit of a long bit sketch, so two sketches
differ in at most as many bits as the shingle sets differ in members. Sketches
are cut into more slices than a linked pair may differ in members; by the
pigeonhole principle linked sets share a slice. A slice is carried as a 64-bit
hash of its set bits, so a sketch may have ``SLICE_BITS`` bits a slice and
chance collisions are rare however large the corpus is. Sets that share a slice
are compared by folded sketches, whose distance is at most the symmetric
difference; what that leaves is compared by the sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, Scratch, Words, arrow_map, mix, pieces, segment_sum, signed, text_bytes
from .linkage import Forest, connected_components, shared_keys, sides, tiles, verified_edges

SLICE_BITS = 1 << 16


def bands(percent: int, most: int) -> np.ndarray:
    """First sizes of the bands, up to two beyond ``most``; linked sets are in one band or in neighbours."""
    ratio, out = 10_000 // percent + 9, [1]
    while len(out) < 3 or out[-2] <= most:  # the second ends the band above the largest set's
        out.append(-(-out[-1] * ratio // 100))
    return np.array(out)


def most_apart(percent: int, sizes_sum: np.ndarray) -> np.ndarray:
    """The largest symmetric difference of two linked sets with that sum of sizes."""
    return (100 - percent) * sizes_sum // (100 + percent)


def slice_keys(hashes: np.ndarray, at: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the sketch slices of each set, for its own size band and for the next if a linked set may be there.

    Returns the keys and the set of each. An all-zero slice is left out unless
    so many of a set's slices are zero that a linked set could share no other.
    """
    sizes = np.diff(at)
    starts = bands(percent, int(sizes.max(initial=1)))
    own = np.searchsorted(starts, sizes, side="right") - 1
    keys, owners = [], []
    for step in (0, 1):
        band = own + step
        ends = starts[band + 1]
        fits = sizes > 0
        if step:
            fits &= sizes * 100 >= starts[band] * percent
        apart = most_apart(percent, 2 * (ends - 1))
        fits &= apart > 0
        if not len(who := np.flatnonzero(fits)):
            continue
        count = apart[who] + 2 + apart[who] // 16
        begin = np.cumsum(count) - count
        size = sizes[who]
        rows = np.repeat(np.arange(len(who)), size)
        member = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + at[who][rows]
        h = mix(hashes[member] ^ U64(0xA24BAED4963EE407))
        piece = ((h >> U64(32)) * count[rows].astype(U64) >> U64(32)).astype(np.int64)
        bit = mix((h & U64(SLICE_BITS - 1)) + U64(1))
        slot = begin[rows] + piece
        order = np.argsort(slot, kind="stable")
        value = np.zeros(int(count.sum()), U64)
        slot, bit = slot[order], bit[order]
        firsts = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        value[slot[firsts]] = np.bitwise_xor.reduceat(bit, firsts)
        of = np.repeat(np.arange(len(who)), count)
        index = np.arange(len(of)) - begin[of]
        zero = value == 0
        zeros = np.bincount(of[zero], minlength=len(who))
        keep = ~zero | (zeros >= count - apart[who])[of]
        keys.append(mix(value + mix(band[who][of].astype(U64) * U64(1 << 32) + index.astype(U64)))[keep])
        owners.append(who[of][keep])
    if not keys:
        return np.empty(0, U64), np.empty(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def set_ids(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set, equal for equal sets."""
    return mix(segment_sum(mix(hashes + U64(0x632BE59BD9B4E019)), at) ^ np.diff(at).astype(U64))


def sketch(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The parity sketch of a set: bit b tells whether an odd number of members have the hash b modulo ``bits``, a power of two from 64 on."""
    odd = np.bincount((mix(hashes) & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(U64)


def sketch_bits(size: int) -> int:
    """A bit for each member, at least."""
    return max(64, 1 << int(size - 1).bit_length())


def folded(sketches: list[np.ndarray]) -> np.ndarray:
    """The sketches with as many bits as the shortest has: what a shorter sketch of the same set is."""
    words = min(map(len, sketches))
    return np.stack([np.bitwise_xor.reduce(x.reshape(-1, words)) for x in sketches])


def near_forest(percent: int):
    """(a, b) for ids of one tile whose sizes and sketches allow a link; a forest of them. The input (id, size, sketch, tile, side) is sorted by tile."""

    def link(table: pa.Table, forest: Forest) -> Iterator[tuple[int, int]]:
        size, side = table.column("size").to_numpy(), sides(table)
        sketches = folded([np.frombuffer(x.as_py(), U64) for x in table.column("sketch")])
        rows = np.arange(len(size))
        for i in range(len(size) - 1):
            later = rows[i + 1 :]
            later = later if side is None else later[side[later] != side[i]]
            apart = most_apart(percent, size[later] + size[i])
            fits = np.abs(size[later] - size[i]) <= apart
            later, apart = later[fits], apart[fits]
            later, apart = (x[forest.roots()[later] != forest.find(i)] for x in (later, apart))
            if len(later):
                for j in later[np.bitwise_count(sketches[later] ^ sketches[i]).sum(1, dtype=np.int64) <= apart].tolist():
                    yield i, j

    return link


def linker(k: int, percent: int):
    """Finds linked rows of a tile: sketches first, then the sets themselves."""

    def link(table: pa.Table, forest: Forest) -> Iterator[tuple[int, int]]:
        sets, ids = [], []
        for batch in table.select(["text"]).to_batches():
            for piece in pieces(batch):  # of bounded text
                hashes, at = Words(*text_bytes(piece.column("text"))).sets(k)
                ids.append(set_ids(hashes, at))
                sets += [hashes[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        asked = np.concatenate(ids).view(np.int64) == table.column("id").to_numpy()  # not another text of the same doc_id
        sizes = np.where(asked, [len(x) for x in sets], 0)
        at = np.cumsum([0, *map(len, sets)])
        local = np.unique(np.concatenate(sets), return_inverse=True)[1]
        sketches = folded([sketch(x, 2 * sketch_bits(max(map(len, sets)))) for x in sets]) if len(sets) > 2 else None
        marked, side = np.zeros(int(local.max(initial=0)) + 1, bool), sides(table)
        for i in range(len(sets) - 1):
            later = np.arange(i + 1, len(sets))
            later = later if side is None else later[side[later] != side[i]]
            total = sizes[i] + sizes[later]
            apart = most_apart(percent, total)
            fits = (np.abs(sizes[later] - sizes[i]) <= apart) & (sizes[later] > 0)
            if sketches is not None:
                roots = forest.roots()
                fits &= roots[later] != roots[i]
                later, total, apart = later[fits], total[fits], apart[fits]
                if not len(later):
                    continue
                fits = np.bitwise_count(sketches[later] ^ sketches[i]).sum(1, dtype=np.int64) <= apart
            later, total, apart = later[fits], total[fits], apart[fits]
            if not len(later):
                continue
            marked[local[at[i] : at[i + 1]]] = True
            for j, both, most in zip(later.tolist(), total.tolist(), apart.tolist(), strict=True):
                if forest.find(i) != forest.find(j) and both - 2 * int(marked[local[at[j] : at[j + 1]]].sum()) <= most:
                    yield i, j
            marked[local[at[i] : at[i + 1]]] = False

    return link


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``.

    A text's set is its distinct ``k``-word shingles, A-Z lower-cased (its
    whole word sequence if shorter). Two texts link when 100 * intersection >=
    ``percent`` * union; a component is what links connect and its id is its
    smallest doc_id. A null, empty or wordless text has no shingle and is its
    own component. Equal sets are one class, joined before any comparison, so
    copies and repeated rows cost no pairs. A row with a null doc_id links with
    nothing and has a null component. Other columns are not read. An empty
    table gives an empty result.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def summarise(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes, at = Words(*text_bytes(batch.column("text"))).sets(k)
        sketches = [sketch(hashes[a:b], sketch_bits(b - a)).tobytes() if b > a else None for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(at)), signed(set_ids(hashes, at)), pa.array(sketches, pa.binary())], ["doc_id", "n_shingles", "class_id", "sketch"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for piece in pieces(batch):
                hashes, at = Words(*text_bytes(piece.column("text"))).sets(k)
                ids = set_ids(hashes, at)
                keys, of = slice_keys(hashes, at, percent)
                fresh = np.zeros(len(ids), bool)
                for i, x in enumerate(ids.tolist()):
                    if x not in seen:
                        fresh[i] = True
                        seen.add(x)
                if len(seen) > 1_000_000:  # bounds memory; keys that come again do no harm
                    seen.clear()
                keep = fresh[of]
                yield pa.RecordBatch.from_arrays([signed(keys[keep]), signed(ids[of[keep]])], ["key", "id"])

    rows = scratch.cut(arrow_map(docs, summarise, "doc_id long, n_shingles long, class_id long, sketch binary"))
    classes = rows.where("n_shingles > 0 and doc_id is not null").groupBy("class_id").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"), F.max("sketch").alias("sketch"))
    classes = scratch.cut(classes)
    keys = docs.where("doc_id is not null").select("text").mapInArrow(emit, "key long, id long")
    shared = scratch.cut(keys.repartition("key").sortWithinPartitions("key", "id").mapInArrow(shared_keys, "key long, id long"))
    met = shared.join(classes, shared.id == classes.class_id).select(F.col("key").alias("cluster"), "id", F.col("n_shingles").alias("size"), "sketch")
    near = verified_edges(tiles(met, "size"), near_forest(percent))
    clusters = connected_components(near, scratch).withColumnRenamed("component", "cluster")

    members = classes.join(clusters, classes.class_id == clusters.id).select("doc_id", "id", "cluster", "n_shingles")
    texts = tiles(members, "n_shingles").join(docs, "doc_id").select("tile", "side", "id", "text")
    edges = verified_edges(texts, linker(k, percent))
    linked = connected_components(edges, scratch)

    classes = classes.drop("sketch").join(linked, classes.class_id == linked.id, "left").select("class_id", F.coalesce("component", "class_id").alias("group"), "doc_id")
    named = classes.join(classes.groupBy("group").agg(F.min("doc_id").alias("component_id")), "group").select("class_id", "component_id")
    return (
        rows.drop("sketch").join(named, "class_id", "left")
        .select("doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    )


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with the smallest doc_id of each group linked by ``jaccard_components``; all columns stay.

    Rows whose doc_id is null or whose text has no word stay. Of rows that
    repeat the kept doc_id all stay, as one document.
    """
    groups = jaccard_components(docs, k, percent)
    gone = groups.where("doc_id is not null and doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs.doc_id.cast("long") == gone.gone_id, "left_anti")
