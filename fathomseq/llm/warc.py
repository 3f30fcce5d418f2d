"""WARC records and a Merkle fixity audit of their replicas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Bytes of the smallest range of offsets, and ranges that one of the next level holds.
RANGE_BYTES, FANOUT = 1 << 16, 16


def record(url: Column, record_id: Column, body: Column) -> Column:
    """The bytes of a WARC response record."""
    payload = body.cast("binary")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nWARC-Record-ID: <urn:md5:"), record_id,
        F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), payload, F.lit("\r\n\r\n").cast("binary"))


def layout(pages: DataFrame, files: int) -> DataFrame:
    """(file, page_id, url, place, record): the bytes of the record of each page and what orders records of one page_id and url.

    Pages are dealt to ``files`` by a hash of page_id; null counts as empty.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    deal = F.conv(F.substring(F.md5(text("page_id").cast("binary")), 1, 8), 16, 10).cast("long")
    whole = record(text("url"), F.md5(F.concat(text("page_id"), F.lit("|"), text("url")).cast("binary")), text("html"))
    rows = pages.select(F.pmod(deal, F.lit(files)).alias("file"), F.col("page_id").cast("long").alias("page_id"), text("url").alias("url"), whole.alias("record"))
    return rows.select("file", "page_id", "url", F.sha2("record", 256).alias("place"), "record")


def hashed(rows: DataFrame) -> DataFrame:
    """(file, offset, bytes, digest, page_id, url) of the records of ``layout``.

    They stand in each file by page_id, url and place; a record's offset is
    the sum of the bytes before it in its file.
    """
    rows = rows.select("file", "page_id", "url", "place", F.octet_length("record").cast("long").alias("bytes"), F.sha2("record", 256).alias("digest"))
    order = Window.partitionBy("file").orderBy("page_id", "url", "place").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("file", F.coalesce(F.sum("bytes").over(order), F.lit(0)).cast("long").alias("offset"), "bytes", "digest", "page_id", "url")


def records(pages: DataFrame, files: int) -> DataFrame:
    """(file, offset, bytes, digest, page_id, url) of the record of each page, in ``files`` files."""
    return hashed(layout(pages, files))


def read_warc(spark, path: str) -> DataFrame:
    """(file, offset, bytes, digest, page_id, url) of the records in WARC files, plain or in gzip members; page_id is null.

    Offsets and bytes are those of the plain content. Each file is read whole
    by one task, so files should be of the usual 1 GB at most. A record that
    ends early has the bytes that are there, as has a gzip member that does;
    what follows a member that can't be read is not looked at.
    """
    import hashlib
    import re
    import zlib

    import pyarrow as pa

    def plain(content: bytes) -> bytes:
        parts = []
        while content[:2] == b"\x1f\x8b":
            member = zlib.decompressobj(zlib.MAX_WBITS | 16)
            try:
                parts.append(member.decompress(content))
            except zlib.error:
                break
            content = member.unused_data
        return b"".join(parts) if parts else content

    def parse(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                content = plain(content)
                at, rows = 0, []
                while (head := content.find(b"\r\n\r\n", at)) >= 0:
                    fields = content[at:head]
                    length = re.search(rb"(?i)^content-length:\s*(\d+)", fields, re.M)
                    url = re.search(rb"(?i)^warc-target-uri:\s*(.*?)\r?$", fields, re.M)
                    end = min(len(content), head + 8 + int(length[1] if length else 0))
                    rows.append((name, at, end - at, hashlib.sha256(content[at:end]).hexdigest(), None, url[1].decode(errors="replace") if url else ""))
                    at = end
                columns = list(zip(*rows, strict=True)) or [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()], strict=True)], ["file", "offset", "bytes", "digest", "page_id", "url"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(parse, "file string, offset long, bytes long, digest string, page_id long, url string")


def write_warc(pages: DataFrame, path: str) -> None:
    """The records of (page_id, url, html) as one WARC file for each partition.

    The text sink ends each value with the line feed that ends a record.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    whole = record(text("url"), F.md5(F.concat(text("page_id"), F.lit("|"), text("url")).cast("binary")), text("html"))
    pages.select(whole.cast("string").alias("whole")).selectExpr("left(whole, length(whole) - 1) as value").write.text(path)


def audit(primary: DataFrame, replica: DataFrame, fanout: int = FANOUT, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, offset, bytes, page_id, url, damage) of the records that differ between two replicas.

    A leaf is a record's digest; a node of level 1 is the hash of the leaves
    that begin in one range of ``range_bytes`` offsets, in order, and a node
    of each next level the hash of ``fanout`` neighbouring nodes, up to one
    root for each file. Roots are compared first and only the children of
    nodes that differ are looked at, level by level. A record that is lost or
    of another length shifts those after it in its file, so ranges that differ
    hold sound records at other offsets: within them, records of one file are
    paired by digest (these are sound), then by page_id, url and offset, then
    by page_id and url, then by offset. ``damage`` is changed for the latter
    three, missing for records that only the primary has left, and extra for
    those that only the replica has; offsets are the primary's but for extra
    ones. Equal records count as often as they stand there. Rows with a null
    file or offset are left out. Empty tables have no root, so each record of
    the other is found.
    """
    scratch = Scratch(primary.sparkSession)
    sides = []
    for df in (primary, replica):
        leaf = F.concat_ws(":", "offset", "bytes", "digest")
        rows = df.where("file is not null and offset is not null").select(F.col("file").cast("string").alias("file"), "offset", "bytes", "page_id", "url", "digest", leaf.alias("hash"))
        sides.append(scratch.cut(rows))
    most = [s.agg(F.max("offset")).first()[0] or 0 for s in sides]
    spans = [range_bytes]
    while spans[-1] <= max(most):
        spans.append(spans[-1] * fanout)

    def up(nodes: DataFrame, by: str, span: int) -> DataFrame:
        ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(by, "hash"))), lambda x: x["hash"]), "|")
        return nodes.groupBy("file", F.floor(F.col(by) / span).cast("long").alias("node")).agg(F.sha2(F.concat(F.lit("node|"), ordered).cast("binary"), 256).alias("hash"))

    trees = []
    for rows in sides:
        levels = [scratch.cut(up(rows, "offset", spans[0]))]
        for _ in spans[1:]:
            levels.append(scratch.cut(up(levels[-1], "node", fanout)))
        trees.append(levels)

    open_nodes = None
    for level in reversed(range(len(spans))):
        a, b = (t[level] for t in trees)
        if open_nodes is not None:
            inside = open_nodes.withColumnRenamed("node", "parent")
            a, b = (x.withColumn("parent", F.floor(F.col("node") / fanout).cast("long")).join(inside, ["file", "parent"], "left_semi").select("file", "node", "hash") for x in (a, b))
        both = a.withColumnRenamed("hash", "ours").join(b.withColumnRenamed("hash", "theirs"), ["file", "node"], "full")
        open_nodes = scratch.cut(both.where("not (ours <=> theirs)").select("file", "node"))

    ours, theirs = (s.withColumn("node", F.floor(F.col("offset") / spans[0]).cast("long")).join(open_nodes, ["file", "node"], "left_semi").drop("node", "hash") for s in sides)
    _, ours, theirs = paired(ours, theirs, ["digest"], scratch)
    changed = []
    for by in (["page_id", "url", "offset"], ["page_id", "url"], ["offset"]):
        both, ours, theirs = paired(ours, theirs, by, scratch)
        changed.append(both)
    out = None
    for rows, damage in [*((x, "changed") for x in changed), (ours, "missing"), (theirs, "extra")]:
        rows = rows.select("file", "offset", "bytes", "page_id", "url", F.lit(damage).alias("damage"))
        out = rows if out is None else out.union(rows)
    return out


def paired(ours: DataFrame, theirs: DataFrame, by: list[str], scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of ``ours`` that have a partner in ``theirs`` of the same file and ``by``, and what is left of both; the n-th by offset is the n-th's partner."""
    order = Window.partitionBy("file", *by).orderBy("offset", "digest")
    a, b = (x.withColumn("nth", F.row_number().over(order)) for x in (ours, theirs))
    columns = ours.columns
    rows = a.select(F.struct(*columns).alias("a"), "nth", "file", *by)
    other = b.select(F.struct(*columns).alias("b"), *[F.col(c).alias(f"their_{c}") for c in ("nth", "file", *by)])
    same = [F.col(c).eqNullSafe(F.col(f"their_{c}")) for c in ("nth", "file", *by)]
    rows = scratch.cut(rows.join(other, same, "full").select("a", "b").where("a is null or b is null" if by == ["digest"] else "true"))
    return rows.where("a is not null and b is not null").select("a.*"), rows.where("b is null").select("a.*"), rows.where("a is null").select("b.*")
