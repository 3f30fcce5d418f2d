"""Splicing events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def psi(events: DataFrame, tpm: DataFrame) -> DataFrame:
    """(event, sample, psi): the share of an event's transcripts' expression that includes it; null where there is none.

    ``events`` is (event, inclusion, total) with arrays of transcript ids, ``tpm`` is (id, sample, value).
    """
    members = events.select("event", F.explode("total").alias("id"), "inclusion").withColumn("included", F.array_contains("inclusion", F.col("id"))).drop("inclusion")
    sums = members.join(tpm, "id").groupBy("event", "sample").agg(F.sum(F.when(F.col("included"), F.col("value")).otherwise(0.0)).alias("inside"), F.sum("value").alias("all"))
    return sums.select("event", "sample", F.try_divide("inside", "all").alias("psi"))
