"""Streaming forms, run to completion over the files of a folder."""

from __future__ import annotations

import uuid

from datetime import timedelta

from pyspark.sql import functions as F

from checks import selection
from checks.assembly import aligned
from checks.inputs import AS_OF, pieces, plain, pst, pst_sql, table
from checks.payloads_json import day_text, key, s
from checks.registry import ORACLES, query
from vacancia.session import work_folder
from vacancia.sources import RAW_DDL, careers_json
from vacancia.sources.payloads import ParseOptions
from vacancia.streaming.postings import (
    judge_repeats, read_landed, stream_dedup, stream_enrich, stream_normalize, write_available,
)


def _folder(spark, name):
    return work_folder(spark, f"{name}-{uuid.uuid4().hex}")


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup_query(spark, sf):
    """Events as a stream; one row per user and kind of event within the delay."""
    schema = table(spark, sf, "events").schema
    stream = read_landed(spark, sf, schema, "events.parquet")
    once = stream_dedup(stream.select("user_id", "event_type", "ts"), ["user_id", "event_type"], "60 days")
    path = _folder(spark, "stream-dedup")
    write_available(once, path, f"{path}-checkpoint")
    return spark.read.parquet(path).select("user_id", "event_type")


@query(
    "stream_normalize",
    pst_sql(
        "SELECT "
        + aligned(
            {
                "id": "'greenhouse:acme:' || CAST(seq AS VARCHAR)", "site": "'greenhouse'", "job_url": "job_url", "title": "title",
                "company": "company_name", "location": "'Cork, Ireland'", "date_posted": "CAST(date_posted AS VARCHAR)", "is_remote": "false",
                "description": "'plain'",
            }
        )
        + " FROM pst"
    ),
)
def stream_normalize_query(spark, sf):
    """Landed payloads written as files, then read, parsed and normalised as a stream."""
    job = s(
        id=key(), title=F.col("title"), absolute_url=F.col("job_url"), location=s(name="Cork, Ireland"), content="plain", updated_at=day_text(),
    )
    landed = pst(spark, sf).select(
        "seq", F.lit("greenhouse").alias("site"), F.lit(None).cast("timestamp").alias("fetched_at"),
        F.lit("https://boards.greenhouse.io/acme").alias("url"), F.col("company_name").alias("company"),
        F.to_json(s(jobs=F.array(job))).alias("payload"),
    )
    folder = _folder(spark, "landed")
    landed.write.parquet(folder)
    stream = read_landed(spark, folder, RAW_DDL)
    options = ParseOptions(as_of=AS_OF)
    flat = stream_normalize(stream, lambda raw: careers_json.GREENHOUSE.parse(raw, options))
    path = _folder(spark, "stream-postings")
    write_available(flat, path, f"{path}-checkpoint", ["site"])
    back = spark.read.schema(flat.schema).parquet(path)
    return plain(back.select(*flat.columns))


@query(
    "judge_repeats",
    """SELECT user_id, event_type, count(*) AS n_rows, 1 AS n_kept FROM events WHERE ts IS NOT NULL GROUP BY ALL""",
)
def judge_repeats_query(spark, sf):
    """Events that land in four lots of files, each with all times: kept, repeated and late rows add up to all of them."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts").where("ts is not null")
    landed = _folder(spark, "events")
    files = pieces(table(spark, sf, "events"))  # of one batch
    for part in range(4):  # one after another, as files are taken by their times
        events.where(F.pmod("event_id", F.lit(4)) == part).repartition(files).write.mode("append").parquet(landed)
    stream = read_landed(spark, landed, events.schema, files=files)
    # The delay is longer than the table's times reach, so a key is held from its first row to the end.
    judged = judge_repeats(stream, ["user_id", "event_type"], timedelta(days=4000))
    path = _folder(spark, "judged")
    write_available(judged, path, f"{path}-checkpoint")
    kept = F.count_if(F.col("status") == "kept").cast("int")
    return spark.read.parquet(path).groupBy("user_id", "event_type").agg(F.count("*").alias("n_rows"), kept.alias("n_kept"))


@query("stream_enrich", ORACLES["enrich_with_details"])
def stream_enrich_query(spark, sf):
    """Listings and details that land as files of two streams: the same rows as from the join of the tables.

    A listing without a detail is given out when later files have moved both watermarks past it.
    """
    hour = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.pmod("n", F.lit(24)).cast("int"))
    listing, details = selection.listings_and_details(spark, sf)
    frames = {
        "listings": listing.withColumn("n", F.col("seq")).withColumn("fetched_at", hour).drop("n"),
        "details": details.withColumn("n", F.xxhash64("id")).withColumn("fetched_at", hour).drop("n"),
    }
    streams = []
    files = max(pieces(table(spark, sf, name)) for name in ("orders", "documents"))  # of one batch
    for name, frame in frames.items():
        folder = _folder(spark, name)
        (frame.repartition(files) if name == "details" else frame).write.parquet(folder)  # postings are dealt out already
        for day in (30, 60):  # nothing but the time is of interest; as many files, so each day has a batch of its own
            tick = spark.range(0, files, 1, files).select(*[F.lit("tick" if f.name == "id" else None).cast(f.dataType).alias(f.name) for f in frame.schema])
            later = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(days=F.lit(day))
            tick.withColumn("fetched_at", later).write.mode("append").parquet(folder)
        streams.append(read_landed(spark, folder, frame.schema, files=files))
    done = stream_enrich(*streams, delay=timedelta(days=2))
    path = _folder(spark, "enriched")
    write_available(selection.enriched(done), path, f"{path}-checkpoint")
    back = spark.read.schema("seq bigint, id string, description string, emails string, job_type string").parquet(path)
    return back.where("seq is not null")  # a filter of the stream would hide the ticks from its watermark
