"""Incremental jobs over newly landed files."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from vacancia.operators.assemble import flatten_postings
from vacancia.operators.enrich import completed, detail_side
from vacancia.plans.collect import parsers
from vacancia.registry import site_names
from vacancia.sources.payloads import ParseOptions

# The stateful function travels to the executors with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What becomes of a row of ``judge_repeats``.
KEPT, REPEATED, LATE = "kept", "repeated", "late"
#: Mark that Spark leaves on a column with a watermark.
_WATERMARK = "spark.watermarkDelayMs"


def _millis(delay: timedelta) -> int:
    return int(delay / timedelta(milliseconds=1))


def _timed(stream: DataFrame, ts: str, delay: timedelta) -> DataFrame:
    """The stream with a watermark on ``ts``, unless there is one (set before its payloads were parsed)."""
    if _WATERMARK in stream.schema[ts].metadata:
        return stream
    return stream.withWatermark(ts, f"{_millis(delay)} milliseconds")


def stream_dedup(
    stream: DataFrame, keys: Sequence[str], delay: str = "1 day", ts: str = "ts"
) -> DataFrame:
    """First row per key; repeats are dropped while the key is held, then its state is freed.

    Watermarks need a zoned timestamp, so a plain one is read as UTC.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def _exact_key(df: DataFrame, keys: Sequence[str]) -> Column:
    """One text per key, equal where grouping takes keys as equal; a null is a value of its own."""
    kinds = dict(df.dtypes)
    parts = [(F.col(k) + F.lit(0).cast(kinds[k])).alias(k) if kinds[k] in ("float", "double") else F.col(k) for k in keys]  # -0.0 is 0.0
    day = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    return F.to_json(F.struct(*parts), {"timestampFormat": f"{day}XXX", "timestampNTZFormat": day})


def judge_repeats(
    stream: DataFrame, keys: Sequence[str], delay: timedelta = timedelta(days=1), ts: str = "ts", buckets: int = 1024
) -> DataFrame:
    """Every row of a stream with a ``status``: ``kept``, ``repeated`` or ``late``. Nothing is lost.

    A key's first row is kept and holds the key until the watermark has passed its time by ``delay``;
    what comes meanwhile is repeated. A row older than the watermark is late, whether it is a first one or
    a repeat, and so is one without a time. A timer frees a key when the watermark has left it behind.

    Python is called once per bucket of keys and batch, and a bucket's state holds its keys. So ``buckets``
    is to grow with the keys that are held at a time; it stays the same for a checkpoint.
    """
    keys, hold, columns = list(keys), max(_millis(delay), 1), stream.columns
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{hold} milliseconds")
    # Spark drops rows that are late by the column that bears the watermark before a stateful function
    # sees them. So another column bears its mark there, by which no row of this century is late.
    never_late = (F.col(ts) + F.expr("INTERVAL 100 YEARS")).alias("__clock", metadata={_WATERMARK: hold})
    timed = timed.select(*[F.col(c).alias(c, metadata={}) if c == ts else F.col(c) for c in columns],
                         F.unix_millis(ts).alias("__ms"), never_late, _exact_key(timed, keys).alias("__key"))
    timed = timed.withColumn("__bucket", F.pmod(F.xxhash64("__key"), F.lit(buckets)).cast("int"))

    def judged(bucket: tuple, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        held = {k: until for k, until in zip(*state.get) if until >= now} if state.exists else {}
        for rows in pieces:
            ms = rows["__ms"].to_numpy(dtype=float)
            late = np.isnan(ms) | (now > 0) & (ms < now)
            status = np.where(late, LATE, REPEATED).astype(object)
            on_time = np.nonzero(~late)[0]
            names = rows["__key"].iloc[on_time]
            for i, key in zip(on_time[~names.duplicated().to_numpy()], names.drop_duplicates()):
                if key not in held:
                    status[i] = KEPT
                    held[key] = int(ms[i]) + hold
            yield rows[columns].assign(status=status)
        if held:
            state.update((list(held), list(held.values())))
            state.setTimeoutTimestamp(min(held.values()))
        elif state.exists:
            state.remove()

    schema = T.StructType([*timed.select(*columns).schema, T.StructField("status", T.StringType())])
    held_ddl = "keys array<string>, until array<bigint>"
    return timed.groupBy("__bucket").applyInPandasWithState(judged, schema, held_ddl, "append", "EventTimeTimeout")


def stream_enrich(
    listings: DataFrame, details: DataFrame, on: Sequence[str] = ("id",), override: Sequence[str] = ("description",),
    fill: Sequence[str] = (), job_type: str = "replace", ts: str = "fetched_at", delay: timedelta = timedelta(days=1),
) -> DataFrame:
    """Streams of listings and of details, joined as ``enrich_with_details`` joins tables.

    Both carry the time ``ts`` at which they were fetched. A detail completes the listings that were
    fetched within ``delay`` of it, whichever comes first; of a key's details within that time the first
    counts. A listing is given out when its detail is there, or without one when the watermark of both
    streams says that none can come any more; then its state is freed. Rows that a filter drops, before or
    after, don't move the watermarks, as Spark filters first.
    """
    on, kinds = list(on), dict(details.dtypes)
    first = _timed(details, ts, delay).dropDuplicatesWithinWatermark(on)
    theirs = detail_side(first, [*on, ts], override, fill).withColumnsRenamed({c: f"__on_{c}" for c in [*on, ts]})
    mine = _timed(listings, ts, delay)
    reach = F.expr(f"INTERVAL '{_millis(delay) / 1000:.3f}' SECOND")
    near = F.col(f"__on_{ts}").between(F.col(ts) - reach, F.col(ts) + reach)
    for c in on:
        near = near & (F.col(c) == F.col(f"__on_{c}"))
    return completed(mine.join(theirs, near, "left_outer"), listings.columns, kinds, override, fill, job_type)


def stream_site(stream: DataFrame, site: str, options: ParseOptions | None = None, country: str = "usa", annual: bool = False) -> DataFrame:
    """``stream_normalize`` of one site's payloads, built-in or added, by its own parser."""
    options = options or ParseOptions()
    (name,) = site_names(site)
    return stream_normalize(stream.where(F.col("site") == name), parsers(options)[name], country, annual)


def stream_normalize(
    stream: DataFrame,
    parse: Callable[[DataFrame], DataFrame],
    country: str = "usa",
    annual: bool = False,
) -> DataFrame:
    """The batch projection over a stream of payloads; it keeps no state and readers sort."""
    return flatten_postings(parse(stream), country, annual)


def read_landed(
    spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files: int | None = None
) -> DataFrame:
    """New Parquet files of a folder as a stream, so many ``files`` at a time (all by default)."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(folder)


def write_available(
    df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Process everything that has arrived, append it to a table, and stop."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start()
    query.awaitTermination()
    return query
