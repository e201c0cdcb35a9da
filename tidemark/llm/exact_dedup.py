"""Exact deduplication by content sort.

Spark samples splitters, range-partitions the normalised texts, sorts every partition externally
(spilling as needed) so that equal texts become neighbours, and the window's group boundaries compare
neighbouring texts in full. The range key is the beginning of the normalised text with a 64-bit digest of
its length and both ends behind it: it orders by content, stays small in the splitter sample, is the same
for equal texts, and texts with a long common beginning still spread over many partitions. Whole texts are
normalised once, behind the shuffle.

A text that is so frequent that it would fill a partition by itself (at most ``4 * shuffle partitions``
of them can exist) never enters the sort: its rows are combined before the shuffle by a partial
aggregation on the full text.

Nulls and ties: a null text counts as empty; null ids sort below all others; of rows that repeat both id
and text one stays. Very long texts are compared whole. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, table

PREFIX_CHARS = 32
END_CHARS = 256


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", carry: bool = False) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``, and with ``carry`` the row as ``row``.

    ``keep`` names the identifier that stays of equal texts: ``smallest`` or ``largest``.
    """
    largest = keep == "largest"
    best = F.max if largest else F.min
    spark = df.sparkSession
    with_row = ["row"] if carry else []
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *([F.struct("*").alias("row")] if carry else []))
    ends = [ascii_lower(F.substring("text", at, END_CHARS)) for at in (1, -END_CHARS)]
    rows = rows.select("id", "text", *with_row, F.xxhash64(F.octet_length("text"), *ends).alias("h"))
    norm, sha = ascii_lower(F.col("text")).alias("norm"), F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")

    total = df.count()
    most = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # At most ``most`` digests can have a share of 1/most of the rows, so this collect has a proven bound.
    hot = [r.h for r in rows.groupBy("h").count().where((F.col("count") > 1) & (F.col("count") * most > total)).collect()]

    cold = rows.where(~F.col("h").isin(hot)) if hot else rows
    prefix = ascii_lower(F.substring("text", 1, PREFIX_CHARS))
    ranged = cold.withColumn("prefix", prefix).repartitionByRange("prefix", "h").select("id", "prefix", "h", norm, *with_row)
    group = Window.partitionBy("prefix", "h", "norm")
    order = F.col("id").desc_nulls_last() if largest else F.col("id").asc_nulls_last()
    found = ranged.select(
        "id",
        F.row_number().over(group.orderBy(order)).alias("nth"),
        best("id").over(group).alias("keep_id"),
        F.count(F.lit(1)).over(group).alias("group_size"),
        "norm",
        *with_row,
    ).select("id", "nth", "keep_id", "group_size", sha, *with_row)

    if hot:
        frequent = rows.where(F.col("h").isin(hot))
        groups = (
            frequent.select("id", norm)
            .groupBy("norm")
            .agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .select(sha, "keep_id", "group_size")
        )
        # As many groups as hot texts at most.
        again = frequent.select("id", norm, *with_row).select("id", sha, *with_row).join(F.broadcast(groups), "text_sha256")
        of_best = F.col("id").eqNullSafe(F.col("keep_id"))
        # Of rows that repeat the best id one of each partition meets the others'.
        ones = again.where(of_best).withColumn("part", F.spark_partition_id())
        ones = ones.withColumn("near", F.row_number().over(Window.partitionBy("text_sha256", "part").orderBy("id")))
        first = F.col("near") == 1
        ones = ones.withColumn("nth", F.row_number().over(Window.partitionBy("text_sha256", F.when(first, -1).otherwise(F.col("part"))).orderBy("near")))
        ones = ones.withColumn("nth", F.when(first, F.col("nth")).otherwise(2)).drop("part", "near")
        again = again.where(~of_best).withColumn("nth", F.lit(2)).unionByName(ones)
        found = found.unionByName(again.select(*found.columns))

    return found.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        ((F.col("nth") == 1) & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
        *with_row,
    )


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    return exact_dedup(df, id_col, text_col, keep, carry=True).where("kept").select("row.*")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


OP4_SQL = """
with t as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm from documents
)
select doc_id, max(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
       doc_id = max(doc_id) over (partition by norm) as kept, sha256(norm) as text_sha256
from t
"""
