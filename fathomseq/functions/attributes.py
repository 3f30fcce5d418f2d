"""Expressions over the attribute column of GTF and GFF3."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The keys that a collapsed gene's attributes begin with, in order; status keys only where the gene has a status.
REQUIRED_KEYS = ["gene_id", "transcript_id", "gene_type", "gene_status", "gene_name", "transcript_type", "transcript_status", "transcript_name", "level"]
STATUS_KEYS = ["gene_status", "transcript_status"]


def pairs(text: Column, gff3: bool = False) -> Column:
    """Array of (key, value) in order, without quotes; of a GTF value with spaces, the first word; pieces without a value are left out."""
    pieces = F.filter(F.transform(F.split(F.replace(text, F.lit('"'), F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")
    mark = "=" if gff3 else " +"
    parts = F.filter(F.transform(pieces, lambda x: F.split(x, mark)), lambda x: F.size(x) > 1)
    return F.transform(parts, lambda x: F.struct(x[0].alias("key"), x[1].alias("value")))


def attribute_map(parsed: Column) -> Column:
    """Map of the pairs; the last of a repeated key wins, and ``tag`` is left out."""
    own = F.filter(parsed, lambda x: x["key"] != "tag")
    last = F.filter(own, lambda x, i: ~F.exists(F.slice(own, i + 2, F.size(own)), lambda y: y["key"] == x["key"]))
    return F.map_from_entries(last)


def tags(parsed: Column) -> Column:
    """Values of all ``tag`` pairs, in order."""
    return F.transform(F.filter(parsed, lambda x: x["key"] == "tag"), lambda x: x["value"])


def collapsed_attributes(attributes: Column) -> Column:
    """A gene's attribute text with the transcript's keys filled in from the gene's.

    Required keys come first, in order, the others after by name. A missing
    required key makes the row fail, as it would make an invalid record.
    """
    has_status = F.map_contains_key(attributes, F.lit("gene_status"))
    value = lambda k: F.coalesce(F.try_element_at(attributes, F.lit(k)), F.try_element_at(attributes, F.lit(k.replace("transcript", "gene"))))
    one = lambda k: F.concat(F.lit(k), F.lit(' "'), F.coalesce(value(k), F.raise_error(F.lit(f"attribute {k} is missing"))), F.lit('"'))
    first = [F.when(has_status, one(k)) if k in STATUS_KEYS else one(k) for k in REQUIRED_KEYS]
    rest = F.filter(F.array_sort(F.map_keys(attributes)), lambda k: ~k.isin(REQUIRED_KEYS))
    more = F.array_join(F.transform(rest, lambda k: F.concat(k, F.lit(' "'), F.element_at(attributes, k), F.lit('"'))), "; ")
    return F.concat(F.concat_ws("; ", *first, F.when(F.size(rest) > 0, more)), F.lit(";"))
