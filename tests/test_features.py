"""Added boards, streams that lose nothing, tables that are written again, and payloads that used to fail."""

import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vacancia import registry
from vacancia.operators import dedup, filters
from vacancia.plans.collect import (
    PLATFORMS_WITH_PARSERS, SearchSpec, collect_landed, parse_landed, parsers, quarantine_landed, quarantines,
)
from vacancia.schema import POSTING_DDL, posting_columns
from vacancia.session import work_folder
from vacancia.sources import RAW_DDL, boards_json, sinks
from vacancia.sources.payloads import ParseOptions
from vacancia.streaming.postings import judge_repeats, read_landed, stream_enrich, stream_site, write_available


def folder(spark, name):
    return work_folder(spark, f"{name}-{uuid.uuid4().hex}")


def landed_files(spark, schema, *files):
    """A stream of one file after another."""
    path = folder(spark, "landed")
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return read_landed(spark, path, spark.createDataFrame([], schema).schema, files=1)


def run(spark, stream):
    path = folder(spark, "out")
    write_available(stream, path, f"{path}-checkpoint")
    return spark.read.schema(stream.schema).parquet(path).collect()


def at(hour):
    return datetime(2024, 1, 1) + timedelta(hours=hour)


@pytest.fixture
def acme():
    def parse(raw, options):
        title = F.get_json_object("payload", "$.title")
        return raw.where(title.isNotNull()).select(*posting_columns(
            seq=F.col("seq"), pos=F.lit(0), site=F.lit("whatever"), id=F.concat(F.lit("acme-"), F.col("seq").cast("string")), title=title,
            job_url=F.col("url"), description=F.get_json_object("payload", "$.text"),
        ))

    def details(raw, options):
        return raw.select("seq", F.concat(F.lit("acme-"), F.get_json_object("payload", "$.of")).alias("id"),
                          F.get_json_object("payload", "$.text").alias("description"))

    board = registry.Board("acme", parse, details=registry.Details(details))
    registry.register(board)
    yield board
    registry.unregister("acme")


def test_an_added_board_is_one_like_any_other(spark, acme):
    rows = [(1, "acme", None, "https://acme.test/1", None, '{"title": "Cook", "text": "short"}'), (2, "acme", None, "https://acme.test/2", None, "[oops"),
            (3, "acme_detail", None, None, None, '{"of": "1", "text": "the long text"}'), (4, "indeed", None, None, None, "x")]
    raw = spark.createDataFrame(rows, RAW_DDL)
    got = collect_landed(raw, SearchSpec(site_name=" ACME ")).collect()
    assert [(r.site, r.id, r.title, r.description) for r in got] == [("acme", "acme-1", "Cook", "the long text")]
    bad = quarantine_landed(raw, ["acme"]).collect()
    assert [(r.site, r.seq, r.reason) for r in bad] == [("acme", 2, "no posting read")]
    assert "acme" in registry.site_names(None)
    assert filters.site_selection(raw, "Acme").count() == 2
    flat = run(spark, stream_site(landed_files(spark, RAW_DDL, rows[:2], rows[2:]), "acme"))
    assert [(r.site, r.title) for r in flat] == [("acme", "Cook")]


def test_a_board_has_to_give_postings(spark, acme):
    raw = spark.createDataFrame([(1, "odd", None, None, None, "{}")], RAW_DDL)
    for parse, message in ((lambda raw, o: raw.select("seq"), "gives no"), (lambda raw, o: raw.select(*posting_columns(seq=F.col("seq"))).withColumn("title", F.lit(1)), "title int")):
        registry.register(registry.Board("odd", parse))
        try:
            with pytest.raises(ValueError, match=message):
                collect_landed(raw, SearchSpec(site_name="odd"))
        finally:
            registry.unregister("odd")
    for name in ("indeed", "greenhouse", "Odd", "", "x_detail"):
        with pytest.raises(ValueError):
            registry.register(registry.Board(name, acme.parse))
    assert set(registry.PLATFORMS) == set(PLATFORMS_WITH_PARSERS)


def test_names_are_judged_alike_everywhere(spark):
    df = spark.createDataFrame([(1, "indeed"), (2, "greenhouse"), (3, "seek")], "seq long, site string")
    assert [r.seq for r in filters.site_selection(df, [" Indeed ", "GREENHOUSE"]).collect()] == [1, 2]
    assert filters.site_selection(df).count() == 2
    with pytest.raises(ValueError):
        filters.site_selection(df, "monster")


def test_repeated_and_late_rows_are_given_out(spark):
    stream = landed_files(
        spark, "k string, ts timestamp, n int",
        [("a", at(0), 1), ("a", at(1), 2), ("b", at(100), 3)],  # then the watermark stands at hour 98
        [("a", at(2), 4), ("c", at(3), 5), ("b", at(101), 6), ("d", None, 7), ("e", at(99), 8)],
        [("b", at(200), 9), (None, at(200), 10)],  # b is held up to hour 102, and the watermark at 99
        [("b", at(201), 11), (None, at(201), 12)],  # the watermark stands at 198: b is free again
    )
    rows = run(spark, judge_repeats(stream, ["k"], timedelta(hours=2)))
    got = {r.n: r.status for r in rows}
    assert len(rows) == 12 and {n: got[n] for n in (3, 4, 5, 6, 7, 8, 9, 10, 11, 12)} == {
        3: "kept", 4: "late", 5: "late", 6: "repeated", 7: "late", 8: "kept", 9: "repeated", 10: "kept", 11: "kept", 12: "repeated"}
    assert sorted((got[1], got[2])) == ["kept", "repeated"]


def test_details_that_come_late_or_never(spark):
    listing = f"{POSTING_DDL}, fetched_at timestamp"

    def one(seq, hour):
        return {"seq": seq, "id": f"j{seq}", "title": "Cook", "description": "short", "fetched_at": at(hour)}

    empty = {c.split()[0]: None for c in POSTING_DDL.split(", ") if " " in c}
    rows = [[{**empty, **one(1, 0)}, {**empty, **one(2, 0)}, {**empty, **one(3, 1)}], [{**empty, **one(8, 100)}], [{**empty, **one(9, 200)}], [{**empty, **one(10, 300)}]]
    schema = spark.createDataFrame([], listing).schema
    listings = landed_files(spark, schema, *[[tuple(r.get(f.name) for f in schema) for r in part] for part in rows])
    details = landed_files(
        spark, "id string, description string, fetched_at timestamp",
        [("j1", "long one", at(3)), ("j1", "again", at(3))], [("j8", "", at(101)), ("j3", "far too late", at(90))], [("j2", "too late", at(200))], [("j0", "x", at(300))],
    )
    got = {r.seq: r.description for r in run(spark, stream_enrich(listings, details, delay=timedelta(hours=24)))}
    assert got[1] in ("long one", "again") and {s: got[s] for s in (2, 3, 8)} == {2: "short", 3: "short", 8: "short"}


def test_written_again_a_table_stays_the_same(spark):
    path = folder(spark, "table")
    schema = "id string, site string, title string"
    first = spark.createDataFrame([("1", "reed", "a"), ("2", "reed", "b"), ("1", "seek", "c"), (None, "reed", "d"), (None, "reed", "e")], schema)
    write = sinks.table_writer(path)
    write(first, 0)
    batch = spark.createDataFrame([("2", "reed", "B"), ("3", "reed", "f"), (None, "reed", "d")], schema)
    for _ in range(2):
        write(batch, 1)
        back = spark.read.schema(schema).parquet(path).collect()
        assert sorted((r.site, r.id or "", r.title) for r in back) == [
            ("reed", "", "d"), ("reed", "", "e"), ("reed", "1", "a"), ("reed", "2", "B"), ("reed", "3", "f"), ("seek", "1", "c")]
    write(first.limit(0), 2)
    assert spark.read.schema(schema).parquet(path).count() == 6


def test_published_rows_stay_where_they_are(spark):
    name = f"seen_{uuid.uuid4().hex}"
    site = F.when(F.col("id") % 3 == 0, "reed").otherwise("seek").alias("site")
    rows = spark.range(200).select(site, F.col("id").cast("string").alias("id"))
    for part in range(2):
        dedup.publish(rows.where(F.col("id") % 2 == part), name, work_folder(spark, name), buckets=4)
    new = spark.range(150, 250).select(site, F.col("id").cast("string").alias("id"), F.col("id").alias("seq"))
    left = dedup.unpublished(new.withColumn("id", F.when(F.col("seq") != 160, F.col("id"))), name)
    assert sorted(r.seq for r in left.collect()) == [160, *range(200, 250)]
    plan = left._jdf.queryExecution().sparkPlan().toString()
    assert "Bucketed: true" in plan
    # One exchange, of the new rows; the published side is scanned, sorted at most, and joined.
    plan = left._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan, plan


@pytest.mark.parametrize("payload", ["7", "17", "[[[7]]]", '"[[["', "true", "[[[]]]", "{}"])
def test_odd_google_payloads_do_not_stop_a_job(spark, payload):
    raw = spark.createDataFrame([(1, "google", None, None, None, payload)], RAW_DDL)
    assert boards_json.parse_google_page(raw).count() == 0


def test_rows_without_key_and_arrival_are_all_kept(spark):
    for seq, pos in ((None, None), (3, 4)):
        rows = spark.createDataFrame([(seq, pos, "reed", None, None, i) for i in range(4)], "seq long, pos int, site string, id string, job_url string, n int")
        assert dedup.dedup_within_site(rows).count() == 4
        assert dedup.dedup_by_normalized_url(rows).count() == 4


def test_a_page_without_arrival_number_is_no_reject(spark, acme):
    raw = spark.createDataFrame([(None, "acme", None, None, None, '{"title": "Cook"}'), (None, "acme", None, None, None, '{"title": "Chef"}')], RAW_DDL)
    assert quarantine_landed(raw, ["acme"], ParseOptions()).count() == 0


CARDS = {
    "linkedin": ('<div class="base-search-card"><a class="base-card__full-link" href="https://x.test/jobs/view/a-1">a</a></div>',
                 '<div class="base-search-card"><span class="sr-only">Lost</span></div>'),
    "bayt": ('<li data-js-job=""><h2><a href="/en/job-1">Cook</a></h2></li>', '<li data-js-job=""><h2>Lost</h2></li>'),
    "bdjobs": ('<div class="job-item"><a href="/jobdetails/1">Cook</a></div>', '<div class="job-item"><h2>Lost</h2></div>'),
    "jazzhr": ('<li class="list-group-item"><h3 class="list-group-item-heading"><a href="/apply/AbC1/Cook">Cook</a></h3></li>',
               '<li class="list-group-item"><h3 class="list-group-item-heading">Lost</h3></li>'),
    "irish_jobs": ('<article data-testid="job-item"><a data-testid="job-item-title" href="/job1">Cook</a></article>',
                   '<article data-testid="job-item"><a data-testid="job-item-title">Lost</a></article>'),
}


@pytest.mark.parametrize("site", sorted(CARDS))
def test_a_good_card_hides_no_unreadable_one(spark, site):
    good, bad = CARDS[site]
    pages = [f"<ul>{good}{bad}</ul>", f"<ul>{bad}{good}{bad}</ul>", f"<ul>{good}</ul>", "<p>nothing</p>", "", None]
    url = "https://acme.applytojob.com/apply"
    raw = spark.createDataFrame([(i, site, None, url, "Acme", p) for i, p in enumerate(pages)], RAW_DDL)
    found = quarantine_landed(raw, [site])
    got = sorted((r.seq, -1 if r.pos is None else r.pos, r.reason) for r in found.collect())
    whole = [(i, -1, "no posting read") for i in (3, 4, 5)]
    assert got == [(0, 1, "missing field"), (1, 0, "missing field"), (1, 2, "missing field"), *whole]
    kept = parse_landed(raw, [site]).select("seq", "pos").collect()
    assert sorted((r.seq, r.pos) for r in kept) == [(0, 0), (1, 1), (2, 0)]


def test_rejects_of_posts_linked_data_and_google_have_their_place(spark):
    tweet = '{"id": "%d", "handle": "h", "text": "%s"}'
    text = "Now hiring: Senior PHP Developer #php in Berlin, write to us today"
    ld = '<script type="application/ld+json">%s</script>'
    item = '{"@type": "JobPosting", "title": "Cook", "url": "/job1"}'
    record = '["Cook","Acme","Cork",[["https://x.test/1","x"]]]'
    rows = [
        (0, "twitter", f"[{tweet % (1, text)}, {tweet % (2, 'hello')}]"), (1, "twitter", "[]"), (2, "twitter", '{"x": ['),
        (3, "irish_jobs", ld % f'[{item}, {{"@type": "JobPosting", "title": "Lost"}}]'), (4, "irish_jobs", ld % "{oops"),
        (5, "google", f'<script>[[[[[{{"520084652":{record}}}]]]]]</script>'),
        (6, "google", '<script>[[[[[{"520084652":["Cook","Acme","Cork",[]]}]]]]]</script>'), (7, "google", "7"),
        (8, "linkedin_posts", "short"),
    ]
    raw = spark.createDataFrame([(i, s, None, None, None, p) for i, s, p in rows], RAW_DDL)
    found = quarantine_landed(raw, ["twitter", "irish_jobs", "google", "linkedin_posts"])
    got = {(r.seq, r.pos): r.reason for r in found.collect()}
    assert got == {
        (0, 1): "missing field", (1, None): "no posting read", (2, None): "no posting read", (3, 1): "missing field",
        (4, None): "no posting read", (6, 0): "missing field", (7, None): "no posting read", (8, None): "no posting read",
    }


def test_rejects_take_one_scan_of_a_site_and_no_shuffle(spark):
    path = folder(spark, "scanned")
    spark.createDataFrame([(0, "bayt", None, None, None, "<p>")], RAW_DDL).write.parquet(path)
    raw = spark.read.parquet(path)
    for site in quarantines():
        plan = quarantine_landed(raw, [site])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("FileScan") == 1, site
    assert set(quarantines()) == set(parsers(ParseOptions()))


def test_larger_tables_are_dealt_into_more_parts(spark, tmp_path):
    """F6, F10, F15, F16: parts were as many as cores, and streams were landed as one file by one task."""
    from checks import inputs, streams

    sf = str(tmp_path)
    ids = spark.range(40_000)
    wide = F.concat(*[F.sha2(F.concat(F.col("id"), F.lit(f"-{i}")), 256) for i in range(8)])
    ids.select(F.col("id").alias("o_orderkey"), (F.col("id") % 40).alias("o_custkey"), F.lit("2024-01-01").cast("timestamp").alias("o_orderdate"),
               wide.alias("o_orderpriority")).coalesce(1).write.parquet(f"{sf}/orders.parquet")
    spark.range(40).select(F.col("id").alias("c_custkey"), F.lit("C").alias("c_name"), F.lit("S").alias("c_mktsegment"),
                           F.lit(1).alias("c_nationkey")).write.parquet(f"{sf}/customer.parquet")
    spark.range(1).select(F.lit(1).alias("n_nationkey"), F.lit("N").alias("n_name")).write.parquet(f"{sf}/nation.parquet")
    postings = inputs.pst(spark, sf)
    sizes = [r["n"] for r in postings.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > spark.sparkContext.defaultParallelism and sum(sizes) == 40_000 and max(sizes) < 5_000
    spark.range(10).select(F.col("id").alias("doc_id"), F.lit("text").alias("text")).write.parquet(f"{sf}/documents.parquet")
    landed = []
    real, streams.read_landed = streams.read_landed, lambda s, folder, schema, files: landed.append(folder) or real(s, folder, schema, files=files)
    try:
        assert streams.stream_enrich_query(spark, sf).count() == 40_000
    finally:
        streams.read_landed = real
    per_file = [r["n"] for r in spark.read.parquet(landed[0]).where("seq is not null").groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(per_file) > 1 and max(per_file) < 5_000


def test_repeats_are_judged_by_buckets_of_keys(spark):
    def lot(first, hour):
        return [(first + i, None if i == 9 else float(i), at(hour)) for i in range(10)] + [(first + 10, -0.0, at(hour)), (first + 11, 0.0, at(hour))]

    stream = landed_files(spark, "n int, k double, ts timestamp", lot(0, 0), lot(100, 1), lot(200, 9), lot(300, 10))
    path = folder(spark, "out")
    query = write_available(judge_repeats(stream, ["k"], timedelta(hours=2), buckets=2), path, f"{path}-checkpoint")
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 2
    rows = spark.read.parquet(path).collect()
    got = {r.n: r.status for r in rows}
    assert len(rows) == len(got) == 48
    kept = sorted(n for n, status in got.items() if status == "kept")
    zeros = [n for n in kept if n % 100 in (0, 10, 11)]
    assert [n for n in kept if n not in zeros] == [*range(1, 10), *range(301, 310)] and [n // 100 for n in zeros] == [0, 3]
    assert {status for n, status in got.items() if n not in kept} == {"repeated"}
