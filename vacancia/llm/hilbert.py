"""Shards of documents as runs of a Hilbert curve through their metadata."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacancia.llm.common import FILE_ROWS, hidden, keep, pick, small_side

#: Bits of a coordinate: each dimension is cut into 2**BITS cells.
BITS = 5
#: Bytes of a document besides its text.
EXTRA_BYTES = 8
#: Bytes of text that a file of a shard holds, about.
FILE_BYTES = 128 << 20
DIMENSIONS = ("source", "lang", "n_chars")


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points (rows, dimensions) of ``bits``-bit coordinates.

    Neighbours on the curve differ by one in one coordinate. From the highest bit on, each sub-cube is
    turned so that the curve enters it where the one before was left; what remains are the digits of a
    Gray code, whose bits are interleaved.
    """
    x = [cells[:, i].astype(np.uint64) for i in range(cells.shape[1])]
    one = np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        low = np.uint64((1 << bit) - 1)
        for i in range(len(x)):
            turned = (x[i] >> np.uint64(bit)) & one == 1
            swapped = np.where(turned, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = x[0] ^ np.where(turned, low, swapped)
            x[i] = x[i] ^ swapped
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    odd = np.zeros(len(cells), dtype=np.uint64)
    for bit in range(bits - 1, 0, -1):
        odd ^= np.where((x[-1] >> np.uint64(bit)) & one == 1, np.uint64((1 << bit) - 1), np.uint64(0))
    index = np.zeros(len(cells), dtype=np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            index = (index << one) | (((axis ^ odd) >> np.uint64(bit)) & one)
    return index


def running(df: DataFrame, order: Sequence[str], weight: str, rows: int, name: str) -> DataFrame:
    """``df``, written, with ``place`` and ``before``: the rows, and their ``weight``, that come earlier in ``order``.

    Ranges are sorted and summed up each in its task, and the sums of the ranges, one row each, are
    added after. Rows that are equal in all of ``order`` have to be alike. ``rows`` is about their number.
    """
    schema = T.StructType([*df.schema, *[T.StructField(c, T.LongType()) for c in ("range", "place", "before")]])
    at = df.columns.index(weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, seen, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            weights = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            upto = total + np.cumsum(weights)
            more = [np.full(len(weights), number), seen + np.arange(len(weights)), upto - weights]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, more)], [*schema.names])
            seen += len(weights)
            total = int(upto[-1]) if len(upto) else total

    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS))
    found = keep(df.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(run, schema), name)
    sums = found.groupBy("range").agg(F.count("*").alias("rows"), F.sum(weight).alias("sum"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = sums.select(F.col("range").alias("r"), *[
        F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("rows", "sum")
    ])
    joined = found.join(small_side(starts, n), F.col("range") == F.col("r"))
    return joined.select(*df.columns, (F.col("place") + F.col("rows_before")).alias("place"),
                         (F.col("before") + F.col("sum_before")).alias("before"))


def cells(values: DataFrame, column: str, rows: int, bits: int = BITS) -> DataFrame:
    """(value, cell) of a column's distinct values: 2**bits cells with about as many rows each, in order.

    A value's cell is the share of rows with smaller values, so a value with a third of all rows has a
    cell to itself and equal values are never torn apart. Null comes first. ``rows`` is their number.
    """
    counts = keep(values.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")), "values", rows)
    placed = running(counts, ["value"], "n", counts.count(), "cells")
    return placed.select("value", F.expr(f"before * {1 << bits} div {max(rows, 1)}").cast("int").alias("cell"))


def _text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def _identity(key: Column, text: Column) -> list[Column]:
    """What orders documents of one place on the curve: equal texts lie side by side."""
    size = _text_bytes(text) + EXTRA_BYTES
    return [F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), key.alias("key"), size.alias("size")]


ORDER = ("curve", "text_crc32", "key", "size")


class Curve:
    """A curve fitted to the metadata of some documents: for each dimension the cells of its values."""

    def __init__(self, rows: DataFrame, dimensions: Sequence[str], bits: int) -> None:
        """``rows`` has the dimensions as columns ``d0``, ``d1``, ..."""
        if len(dimensions) * bits > 62:
            raise ValueError("more than 62 bits of coordinates")
        self.bits, self.n, self.rows = bits, len(dimensions), rows.count()
        self.cells = [cells(rows, f"d{i}", self.rows, bits) for i in range(self.n)]
        self.sizes = [c.count() for c in self.cells]

    def place(self, df: DataFrame) -> DataFrame:
        """``df`` (d0, d1, ..., more) with ``curve`` instead of the dimensions."""
        bits = self.bits

        @F.pandas_udf("long")
        def index(*axes: pd.Series) -> pd.Series:
            return pd.Series(curve_index(np.stack([a.to_numpy() for a in axes], axis=1), bits).astype(np.int64))

        given = [c for c in df.columns if c not in {f"d{i}" for i in range(self.n)}]
        for i, (known, size) in enumerate(zip(self.cells, self.sizes)):
            known = small_side(known.select(F.col("value").alias(f"v{i}"), F.col("cell").alias(f"c{i}")), size)
            df = df.join(known, F.col(f"d{i}").eqNullSafe(F.col(f"v{i}")))
        return df.select(*given, index(*[F.col(f"c{i}") for i in range(self.n)]).alias("curve"))


def _placed(docs: DataFrame, key: str, text: str, dimensions: Sequence[str], bits: int) -> tuple[Curve, DataFrame]:
    given = {f"d{i}": c for i, c in enumerate(dimensions)}
    picked = pick(docs, key=key, text=text, **given)
    slim = keep(picked.select(*_identity(F.col("key"), F.col("text")), *given), "sized")
    curve = Curve(slim, dimensions, bits)
    return curve, running(curve.place(slim), ORDER, "size", curve.rows, "curve")


def _runs(placed: DataFrame, shards: int) -> DataFrame:
    """With ``shard``: the curve is cut where a document's middle byte passes a multiple of the bytes of a shard."""
    total = placed.agg(F.coalesce(F.sum("size"), F.lit(1))).first()[0]
    shard = F.expr(f"(2 * before + size) * {shards} div (2 * {total})").cast("int")
    return placed.withColumn("shard", shard)


def shard_documents(
    docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text",
    dimensions: Sequence[str] = DIMENSIONS, bits: int = BITS,
) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard, curve) for every document.

    Each dimension is cut into cells that hold about as many documents each; documents are sorted by
    their cells' place on a Hilbert curve, then by text and key; runs of that order with about equal
    bytes (``law``) are the shards. ``slot`` counts a shard's documents in that order. Shards differ by
    no more than the largest document. Only metadata is sorted, in ranges that also split a cell or a
    text with a third of all documents.

    A null or empty text has 8 bytes and checksum zero; null metadata come first; rows that are repeated
    whole take neighbouring slots; an empty table gives an empty result. ``grown_shard`` is null, as
    another number of shards moves all cuts.
    """
    found = _runs(_placed(docs, key, text, dimensions, bits)[1], shards)
    first = found.groupBy("shard").agg(F.min("place").alias("first")).withColumnRenamed("shard", "s")
    return found.join(F.broadcast(first), F.col("shard") == F.col("s")).select(  # a row per shard
        F.col("key").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def write_shards(
    docs: DataFrame, path: str, shards: int = 24, key: str = "doc_id", text: str = "text",
    dimensions: Sequence[str] = DIMENSIONS, bits: int = BITS, file_bytes: int = FILE_BYTES,
) -> None:
    """Write all columns of the documents to ``path/shard=.../``, in the curve's order.

    Every file is a piece of the curve and so has narrow ranges in all dimensions, by which a reader's
    filters skip it. A document finds its shard by the places where the curve was cut, one for each
    shard, not by a join of its key.
    """
    names = docs.columns
    curve, placed = _placed(docs, key, text, dimensions, bits)
    cut = _runs(placed, shards)
    heads = sorted(cut.groupBy("shard").agg(F.min(F.struct(*ORDER)).alias("head")).collect(), key=lambda r: r.shard)
    kinds = {f.name: f.dataType for f in placed.schema}
    spark, df = docs.sparkSession, hidden(docs)
    own = [F.col(f"in_{names.index(c)}") for c in (key, text)]
    df = df.select("*", *_identity(*own), *[F.col(f"in_{names.index(c)}").alias(f"d{i}") for i, c in enumerate(dimensions)])
    cuts = [F.struct(*[F.lit(r["head"][c]).cast(kinds[c]).alias(c) for c in ORDER]) for r in heads]  # one per shard
    passed = F.filter(F.array(*cuts), lambda head: head <= F.struct(*ORDER)) if cuts else F.array()
    numbers = F.array(*[F.lit(r.shard) for r in heads]).cast("array<int>")
    df = curve.place(df).withColumn("shard", F.get(numbers, F.size(passed) - 1))
    total = placed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    files = max(spark.sparkContext.defaultParallelism, shards, -(-total // file_bytes))
    dealt = df.repartitionByRange(files, *ORDER).sortWithinPartitions("shard", *ORDER)
    clash = "shard" if "shard" not in [n.lower() for n in names] else "shard_"
    out = dealt.select(*[F.col(f"in_{i}") for i in range(len(names))], "shard").toDF(*names, clash)
    out.write.partitionBy(clash).parquet(path)
