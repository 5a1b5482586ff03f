"""Helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia.session import cut_lineage

#: Rows of a partition of a narrow frame.
FILE_ROWS = 500_000
#: Rows of a batch that are turned into Python values at once.
CHUNK_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Columns under new names (``new=given``), whatever other columns the frame has.

    Columns are found by position, so neither a repeated name nor one that differs only in case is
    ambiguous; the first column of exactly the given name counts.
    """
    names = df.columns
    plain = df.toDF(*[f"_{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"_{names.index(given)}").alias(new) for new, given in wanted.items()])


def hidden(df: DataFrame) -> DataFrame:
    """The frame with its columns renamed ``in_0``, ``in_1``, ..., which clash with nothing added later."""
    return df.toDF(*[f"in_{i}" for i in range(len(df.columns))])


def shown(df: DataFrame, names: list[str]) -> DataFrame:
    """Undo ``hidden``: its columns alone, under their own names."""
    return df.select(*[F.col(f"in_{i}") for i in range(len(names))]).toDF(*names)


def never_null(column: str) -> Column:
    """A key as text that can be compared with = whether it is null or not."""
    return F.coalesce(F.concat(F.lit("v"), F.col(column).cast("string")), F.lit("n"))


def keep(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """A frame that several later steps read, written to the shared folder and read back.

    Rows get fixed by this: a lost executor costs a read of the files, and a row number given before
    stays the same. Where the number of ``rows`` is known (or a bound), there are as many files as
    they fill, instead of one for each partition of the last shuffle.
    """
    return cut_lineage(df if rows is None else packed(df, rows), f"llm-{name}")


def packed(df: DataFrame, rows: int) -> DataFrame:
    """A narrow frame of known (or bounded) length in as many partitions as its rows fill.

    There are as many as tasks run at once at least. Without it a small result has a partition, and a
    file when it's written, for each partition of the shuffle before.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(least, -(-rows // FILE_ROWS)))


def small_side(df: DataFrame, rows: int, most: int = 100_000) -> DataFrame:
    """The side of a join whose ``rows`` were counted: broadcast up to ``most`` rows, else shuffled.

    Beyond the bound the join is left to the optimizer, which deals both sides by key and splits
    skewed keys.
    """
    return F.broadcast(df) if rows <= most else df


def chunks(batches: Iterator[pa.RecordBatch], rows: int = CHUNK_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few texts are held as Python values at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
