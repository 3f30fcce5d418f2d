"""The queries of this package: name to function of (spark, sf_dir), and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality, toxicity, urlfilter, warc
from .bitsliced import top_products
from .common import Scratch
from .decontaminate import leaks
from .line_dedup import dedup_lines
from .mixing import plan
from .ngram_jaccard import jaccard_components
from .oracle import SQL as ORACLE_SQL  # noqa: F401
from .rollups import TokenRollups, count_tokens, revised, signed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", F.size("removed_lines").alias("n_removed"), "removed_lines")


#: What op2 is given: rules (host, path, verdict) and the hosts that the method lists.
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]
LISTED_HOSTS = [f"{name}.example.{top}" for name in ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm") for top in ("com", "net", "org")]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    hosts = spark.createDataFrame([(h,) for h in LISTED_HOSTS], "host string")
    return urlfilter.judge(table(spark, sf_dir, "pages"), rules, hosts)


def op3_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of a replica in which one record in 64 has a byte altered and one in 64 is lost, so that those after it stand elsewhere."""
    pages = table(spark, sf_dir, "pages")
    rows = warc.layout(pages, max(1, pages.count() // 1000))
    fate = F.substring(F.md5(F.concat(F.lit("replica|"), F.col("page_id").cast("string")).cast("binary")), 1, 2)
    kept = rows.where(F.coalesce(~fate.between("04", "07"), F.lit(True)))
    altered = F.overlay("record", F.lit(b"\x00"), F.expr("cast(octet_length(record) div 2 as int)"))
    ours, theirs = warc.hashed(rows), warc.hashed(kept.withColumn("record", F.when(fate < "04", altered).otherwise(F.col("record"))))
    return warc.audit(ours, theirs).select(F.col("file").cast("long").alias("file"), "offset", "bytes", "page_id", "url", "damage")


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), k=3, percent=90)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_bitsliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"), every=50)


def op7_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches: all documents are counted, those not in English again with another vocabulary, and exact copies are deleted. The last two are committed twice.

    Of rows with one text the one with the least doc_id stays (null last, ties
    by source and lang). Rows without a text are no copies. Nothing is joined:
    what is deleted are all rows with a text, less one for each text.
    """
    scratch = Scratch(spark)
    one, many = "byte_bpe_50k", "byte_bpe_multi_50k"
    again = F.coalesce(F.col("lang") != "en", F.lit(True))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2"), F.col("text").isNotNull().alias("has_text"))
    before = count_tokens(docs, one, to="before", keep_text=True)
    counts = scratch.cut(count_tokens(before.withColumn("text", F.when(again, F.col("text"))), many, to="after"))
    moved = counts.where(again)
    rollups = TokenRollups(spark, f"{scratch.root}/rollups")
    now = counts.where("has_text").select("*", F.when(again, many).otherwise(one).alias("tokenizer"), F.when(again, F.col("after")).otherwise(F.col("before")).alias("tokens"))
    kept = now.groupBy("h1", "h2").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "source", "lang", "tokenizer", "tokens")).alias("kept")).select("kept.*")
    deleted = signed(now, -1, F.col("tokenizer")).union(signed(kept, 1, F.col("tokenizer")))
    rollups.commit("1-insert", signed(counts, 1, one, "before"))
    for _ in range(2):
        rollups.commit("2-recount", revised(moved, one, many, "before", "after"))
        rollups.commit("3-delete", deleted)
    return rollups.totals()


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_tokens", "covered", "coverage", F.size("tiles").alias("n_tiles"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = plan(table(spark, sf_dir, "documents"), weights=(1, 2, 3), epochs=3, seed=1)
    return mixed.select(F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_url_filter,
        op3_warc_fixity,
        op4_ngram_jaccard,
        op5_toxicity,
        op6_bitsliced_topk,
        op7_token_rollups,
        op8_decontamination,
        op9_mixing,
        op10_quality,
    )
}
