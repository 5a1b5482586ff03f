"""Where the output table goes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.session import cut_lineage, path_exists


def sink_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header, every value quoted, ``\\`` as escape."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", "\\")
        .csv(path)
    )


def sink_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet partitioned by site, so that a request for some sites reads only those.

    ``overwrite`` replaces the sites that are written; all others stay as they are.
    """
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("site").parquet(path)


def upsert_table(df: DataFrame, path: str, key: Sequence[str] = ("id",)) -> None:
    """Postings into a table of ``sink_table``: a known key's row is replaced, a new one is added.

    Only sites that occur in ``df`` are read and rewritten, and writing the same rows again changes
    nothing. Of rows of ``df`` with equal keys one stays. A row whose key is null in part is itself its key.
    """
    parts = [F.col(c) for c in key]
    whole = F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)])), 256)
    lacking = F.array_contains(F.transform(F.array(*[p.cast("string") for p in parts]), lambda p: p.isNull()), True)
    named = F.when(lacking, F.concat(F.lit("row "), whole)).otherwise(F.concat(F.lit("key "), F.to_json(F.array(*[p.cast("string") for p in parts]))))
    once = cut_lineage(df.withColumn("__key", named).dropDuplicates(["site", "__key"]), "upsert")
    spark, new = df.sparkSession, once
    if path_exists(spark, path):
        touched = [r[0] for r in once.select("site").distinct().collect()]  # sites, not postings
        known = spark.read.schema(df.schema).parquet(path).where(F.col("site").isin(*touched))
        stays = known.withColumn("__key", named).join(once.select("site", "__key"), ["site", "__key"], "left_anti")
        # Written elsewhere first, as the files that are read are replaced.
        new = cut_lineage(once.unionByName(stays), "upsert")
    sink_table(new.drop("__key"), path, "overwrite")


def table_writer(path: str, key: Sequence[str] = ("id",)) -> Callable[[DataFrame, int], None]:
    """What ``writeStream.foreachBatch`` takes to keep a table: a batch that is tried again does no harm."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch, path, key)

    return write
