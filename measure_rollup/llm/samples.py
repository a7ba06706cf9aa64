"""Bounded samples of labelled documents to learn from, and hold-out rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from measure_rollup.sources.shared import settle

LABELS = 100_000  # whose counts are broadcast


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text modulo ``divisor``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def held_out(doc_id: Column, divisor: int, value: int) -> Column:
    """Whether the rule keeps the document out of learning; documents without an id are kept out."""
    return F.coalesce(remainder(doc_id, divisor) == value, F.lit(True))


def sample(labelled: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` rows of each label: those whose ids hash lowest, ties by id.

    A label's count gives the hash below which a few more than ``rows`` are to be expected, so
    that each task drops the others before anything is ranked or shuffled, whatever a label's
    size and the number of tasks. Rows without a label are left out. Where ids repeat, a
    label may get fewer than ``rows``.
    """
    sizes = settle(labelled.groupBy(label).agg(F.count(F.lit(1)).alias("_size")))
    if sizes.count() <= LABELS:
        sizes = F.broadcast(sizes)
    # hashes are even over the bigints; the surplus is eight times the deviation of the number below
    surplus = rows + 8 * rows**0.5 + 32
    limit = (F.lit(2.0) * F.least(F.lit(1.0), F.lit(surplus) / F.col("_size")) - 1) * F.lit(2.0**63)
    low = (
        labelled.withColumn("_order", F.xxhash64("doc_id"))
        .join(sizes, label)
        .filter(F.col("_order").cast("double") <= limit)
        .drop("_size")
    )
    order = Window.partitionBy(label).orderBy("_order", "doc_id")
    return low.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= rows).select(
        *labelled.columns
    )


def within(chosen: DataFrame, label: str, length: str, total: int) -> DataFrame:
    """The first rows of each label, in the order of ``sample``, until their lengths reach ``total``.

    For samples, which are small: fewer documents, each of them whole, and none left out for its
    size; the last one may go beyond the total.
    """
    so_far = Window.partitionBy(label).orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(length).over(so_far), F.lit(0))
    return chosen.withColumn("_before", before).filter(F.col("_before") < total).drop("_before")
