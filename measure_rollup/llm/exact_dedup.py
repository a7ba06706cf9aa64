"""Exact deduplication by skew-safe combining.

Texts are equal when they are identical after white space (``[\\x20\\x09-\\x0D]``) is
deleted. Groups are combined in three steps, each of which groups by digest *and* full
content, so a digest alone never decides:

1. each task deduplicates what it has read (Spark's partial aggregate; all rows of a
   task carry the task's salt, so a group leaves a task as one row);
2. the tasks' rows are merged by digest, content and salt, so that a group that every
   task has seen meets in ``salts`` places, not in one;
3. the at most ``salts`` winners of a group are combined into one.

Documents then find their winner by digest. Digests that turned out to have several
contents (none, with SHA-256) are joined by content as well.

Defined cases: null text counts as empty, and all empty texts are one group. A null id
sorts after every other id. Rows repeated with the same id and text are members of the
same group, marked alike by ``exact_groups``; ``exact_dedup`` keeps one of them. Empty
tables give empty results. Other columns are neither read nor, in ``exact_groups``,
returned, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from measure_rollup.sources import new_folder

BLANKS = " \t\n\x0b\f\r"
SALTS = 16

_WIDTH = "cast(18446744073709551616 as decimal(20,0))"  # 2^64, above any distance between ids
_NO_ID = "cast(9223372036854775808 as decimal(20,0))"  # 2^63, above any id


def without_blanks(text: Column) -> Column:
    """The text that decides equality."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def sha256(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def _keyed(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("points"),
        without_blanks(F.col("text")).alias("content"),
    )
    return rows.withColumn("digest", digest(F.col("content")))


def _combine(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy("digest", "content", *keys).agg(
        F.max("rank").alias("rank"), F.max("points").alias("points"), F.sum("size").alias("size")
    )


def _winners(rows: DataFrame, salts: int) -> DataFrame:
    """A row per digest and content: the document that stays and the group's size.

    The rank is ``points * 2^64 - id``: its maximum is the most code points, then the
    smallest id. As one number it can be aggregated in place, by hash.
    """
    ranked = rows.select(
        "digest",
        "content",
        "points",
        F.expr(
            f"cast(points as decimal(10,0)) * {_WIDTH}"
            f" - coalesce(cast(doc_id as decimal(20,0)), {_NO_ID})"
        ).alias("rank"),
        F.lit(1).cast("long").alias("size"),
        (F.spark_partition_id() % salts).alias("salt"),
    )
    salted = _combine(ranked, "salt").drop("salt")
    whole = _combine(salted.repartition("digest"))
    keep = F.expr(f"cast(points as decimal(10,0)) * {_WIDTH} - rank")
    return whole.select(
        "digest",
        "content",
        F.when(keep < F.expr(_NO_ID), keep.cast("long")).alias("keep_id"),
        F.col("size").alias("group_size"),
    )


def _settled_winners(rows: DataFrame, salts: int) -> tuple[DataFrame, DataFrame | None]:
    """Winners of digests with one content; those of the other digests, with their content."""
    spark = rows.sparkSession
    path = new_folder(spark, "exact-winners")
    _winners(rows, salts).drop("content").write.parquet(path)
    settled = spark.read.parquet(path)
    shared = settled.groupBy("digest").count().filter("count > 1").select("digest")
    if shared.isEmpty():
        return settled, None
    one = settled.join(shared, "digest", "left_anti")
    several = _winners(rows.join(shared, "digest", "left_semi"), salts)
    return one, several


def exact_groups(
    docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """A row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 (the digest)."""
    rows = _keyed(docs, digest)
    one, several = _settled_winners(rows, salts)
    joined = rows.select("doc_id", "digest").join(one, "digest")
    if several is not None:
        kept = ["doc_id", "digest", "keep_id", "group_size"]
        by_content = rows.join(several, ["digest", "content"]).select(kept)
        joined = joined.select(kept).unionByName(by_content)
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def exact_dedup(
    docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = _keyed(docs, digest)
    one, several = _settled_winners(rows, salts)
    winners = one.select("keep_id", "digest", F.lit(None).cast("string").alias("content"))
    if several is not None:
        winners = winners.unionByName(several.select("keep_id", "digest", "content"))
    whole = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
        F.col("doc_id").cast("long").alias("id"),
        digest(without_blanks(F.col("text"))).alias("sha"),
    )
    content = without_blanks(F.col("row.text"))
    stay = whole.join(
        winners,
        whole.id.eqNullSafe(winners.keep_id)
        & (whole.sha == winners.digest)
        & (winners.content.isNull() | (winners.content == content)),
        "left_semi",
    )
    points = F.length(F.coalesce(F.col("row.text"), F.lit("")))
    keys = ["id", "sha"] if several is None else ["id", "sha", content]
    repeats = Window.partitionBy(*keys).orderBy(points.desc())
    return stay.withColumn("repeat", F.row_number().over(repeats)).filter("repeat = 1").select("row.*")
