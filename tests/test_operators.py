"""Properties of the operators: skew, ranks, duplicates, salary rules, sources, streams."""

import itertools
import json
import time
from datetime import date
from functools import reduce

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import inputs
from vacancia import session
from vacancia.functions import social as social_text
from vacancia.functions.arrays import distinct_by
from vacancia.functions.markup import scan_html
from vacancia.operators import aggregates, assemble, dedup, filters, ranking
from vacancia.operators.dictionary import first_names
from vacancia.operators.enrich import enrich_with_details
from vacancia.operators.skew import hot_keys, salted_join
from vacancia.plans import careers
from vacancia.plans.collect import SearchSpec, collect_postings, site_names
from vacancia.schema import OUTPUT_COLUMNS, POSTING_DDL, as_postings
from vacancia.session import clear_work, cut_lineage, work_folder
from vacancia.sources import RAW_DDL, boards_html, boards_json, career_pages, careers_json, social
from vacancia.sources.payloads import ParseOptions
from vacancia.streaming.postings import read_landed, stream_dedup, stream_normalize, write_available



@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows share one key, some have none."""
    return spark.range(3000).select(
        F.col("id").alias("seq"),
        F.lit(0).alias("pos"),
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 30 == 0, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 200).cast("string"))).alias("key"),
        (F.col("id") % 7).alias("v"),
    )


def raw(spark, rows):
    return spark.createDataFrame(
        [(i, "s", None, url, company, payload) for i, (url, company, payload) in enumerate(rows)], RAW_DDL
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(skewed, how):
    right = skewed.groupBy("key").agg(F.max("seq").alias("top")).where(F.col("key").isNotNull() & (F.col("top") % 2 == 1))
    plain = skewed.join(right, "key", how)
    salted = salted_join(skewed, right, ["key"], how, hot_keys(skewed, ["key"], min_rows=50), salts=4)
    assert sorted(map(str, salted.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_hot_keys_are_found_and_bounded(skewed):
    hot = hot_keys(skewed, ["key"], min_rows=50)
    assert skewed.select(F.xxhash64(F.lit("hot")).alias("h")).first()["h"] in hot and len(hot) <= 2
    assert hot_keys(skewed, ["key"], min_rows=10_000) == []
    assert len(hot_keys(skewed, ["key"], min_rows=1, top=5)) == 5


def test_salted_join_refuses_unlike_keys(skewed):
    right = skewed.select(F.col("seq").cast("int").alias("seq"))
    with pytest.raises(ValueError):
        salted_join(skewed, right, ["seq"])


def test_min_support_and_cascade_and_largest(skewed):
    rows = skewed.where(F.col("key").isNotNull())
    kept = aggregates.min_support(rows, ["key"], 10)
    n = F.count("*").over(Window.partitionBy("key"))
    assert kept.count() == rows.withColumn("n", n).where("n >= 10").count()

    ranked = rows.withColumn("strategy_rank", F.col("v"))
    best = F.min("v").over(Window.partitionBy("key"))
    assert aggregates.strategy_cascade(ranked, ["key"]).count() == ranked.withColumn("b", best).where("b = v").count()

    largest = aggregates.largest_array_wins(rows.withColumn("candidate", F.col("v")), ["key"])
    chosen = {r["key"]: r["candidate"] for r in largest.select("key", "candidate").distinct().collect()}
    counts = rows.groupBy("key", "v").count().collect()
    for key, candidate in chosen.items():
        options = sorted((-r["count"], r["v"]) for r in counts if r["key"] == key)
        assert candidate == options[0][1]


@pytest.mark.parametrize("offset,wanted", [(0, 15), (5, 10), (1500, 700), (0, 1200), (1999, 5000), (5000, 10)])
def test_rows_per_group(skewed, offset, wanted):
    rows = skewed.withColumn("site", F.coalesce("key", F.lit("none")))
    n = F.row_number().over(Window.partitionBy("site").orderBy("seq"))
    expected = {r["seq"] for r in rows.withColumn("n", n).where(F.col("n").between(offset + 1, offset + wanted)).collect()}
    got = [r["seq"] for r in ranking.rows_per_group(rows, wanted, offset, slots=3).collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_small_limits_are_cut_before_the_shuffle(skewed):
    rows = skewed.withColumn("site", F.col("key"))
    plan = ranking.results_wanted(rows, 15)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4
    plan = ranking.first_per_key(rows, ["key"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_dedup_is_idempotent(skewed):
    df = skewed.select("seq", "pos", F.lit("reed").alias("site"), F.col("key").alias("id"), F.lit("u").alias("job_url"))
    once = dedup.dedup_within_site(df)
    assert sorted(once.collect()) == sorted(dedup.dedup_within_site(once).collect())
    assert once.count() == df.select("id").na.drop().distinct().count() + df.where("id IS NULL").count()
    assert dedup.seen_anti_join(df.where("id IS NOT NULL"), once).count() == 0


def test_distinct_by(spark):
    df = spark.sql("SELECT array(named_struct('k','b','v',1), named_struct('k','a','v',2), named_struct('k','b','v',3), named_struct('k','c','v',4)) AS a")
    kept = df.select(distinct_by(F.col("a"), lambda x: x["k"]).alias("a")).first()["a"]
    assert [(r["k"], r["v"]) for r in kept] == [("b", 1), ("a", 2), ("c", 4)]


def postings(spark, rows):
    """Posting records from dicts."""
    body = "\n".join(json.dumps(r) for r in rows)
    df = spark.createDataFrame([(line,) for line in body.split("\n")], "j string")
    return df.select(F.from_json("j", POSTING_DDL).alias("p")).select("p.*")


def test_salary_precedence(spark):
    rows = [
        {"seq": 1, "site": "a", "title": "t", "description": "$50k - $80k", "compensation": {"currency": None}},
        {"seq": 2, "site": "a", "title": "t", "description": "$50k - $80k"},
        {"seq": 3, "site": "a", "title": "t", "compensation": {"interval": "hourly", "min_amount": 25, "max_amount": 30, "currency": "USD"}},
        {"seq": 4, "site": "a", "title": "t", "compensation": {"interval": "hourly", "min_amount": 0, "max_amount": 30, "currency": "USD"}},
    ]
    df = postings(spark, rows)

    def got(**kw):
        return [tuple(r) for r in assemble.flatten_postings(df, **kw).select("interval", "min_amount", "salary_source").collect()]

    assert got() == [(None, None, None), ("yearly", 50000.0, "description"), ("hourly", 25.0, "direct_data"), ("hourly", 0.0, None)]
    assert got(country="ireland")[1] == (None, None, None)
    assert got(annual=True)[2:] == [("yearly", 52000.0, "direct_data"), ("hourly", 0.0, None)]


def test_output_layout_and_order(spark):
    rows = [
        {"seq": 1, "site": "b", "id": "1", "date_posted": "2024-01-01"}, {"seq": 2, "site": "b", "id": "2"},
        {"seq": 3, "site": "b", "id": "3", "date_posted": "2024-02-01"}, {"seq": 4, "site": "a", "id": "4"},
    ]
    out = assemble.normalize_postings(postings(spark, rows))
    assert out.columns == OUTPUT_COLUMNS and len(OUTPUT_COLUMNS) == 34
    assert [r["id"] for r in out.collect()] == ["4", "3", "1", "2"]
    empty = assemble.normalize_postings(postings(spark, rows).where("false"))
    assert empty.columns == OUTPUT_COLUMNS and empty.count() == 0
    assert as_postings(spark.createDataFrame([("x",)], "title string")).first()["title"] == "x"


def test_collect_postings(spark):
    rows = [
        {"seq": i, "pos": 0, "site": "reed", "id": str(i % 40), "job_url": f"u{i}", "title": "Data Analyst" if i % 2 else "Cook", "is_remote": i % 3 == 0,
         "job_type": ["fulltime"], "date_posted": "2024-02-14", "company_name": f"Acme {i % 4}"}
        for i in range(100)
    ]
    df = postings(spark, rows)
    assert collect_postings(df, SearchSpec(results_wanted=None)).count() == 40
    got = collect_postings(df, SearchSpec(search_term='"data analyst" -cook', is_remote=True, job_type="vollzeit", results_wanted=5, as_of="2024-02-15"))
    assert got.count() == 5 and {r["title"] for r in got.collect()} == {"Data Analyst"}
    assert collect_postings(df, SearchSpec(site_name="indeed")).count() == 0
    assert {r["company"] for r in collect_postings(df, SearchSpec(company_name="acme")).collect()} == {"Acme 0"}
    with pytest.raises(ValueError):
        SearchSpec(job_type="forever")
    with pytest.raises(ValueError):
        filters.site_selection(df, "nowhere")


def test_window_days():
    assert filters.window_days(30) == {"indeed": 2, "linkedin": 2, "zip_recruiter": 1, "glassdoor": 1, "naukri": 1, "google": 3}
    assert filters.window_days(200)["google"] == 30


def test_enrich_keeps_what_the_detail_lacks(spark):
    listing = postings(spark, [
        {"seq": 1, "id": "a", "description": "old", "job_type": ["contract"], "emails": ["x@y.zz"]},
        {"seq": 2, "id": "b", "description": "old", "job_type": ["contract"]}, {"seq": 3, "id": "c", "description": "old"},
    ])
    details = spark.createDataFrame([("a", "new full time m@n.oo", date(2024, 1, 1)), ("b", "", None)], "id string, description string, date_posted date")
    rows = {r["id"]: r for r in enrich_with_details(listing, details, fill=("date_posted",)).collect()}
    assert rows["a"]["description"].startswith("new") and rows["a"]["emails"] == ["m@n.oo"] and rows["a"]["job_type"] == ["fulltime"]
    assert rows["a"]["date_posted"] == date(2024, 1, 1)
    assert rows["b"]["description"] == "old" and rows["b"]["job_type"] == ["contract"] and rows["c"]["description"] == "old"
    kept = {r["id"]: r for r in enrich_with_details(listing, details, job_type="fill").collect()}
    assert kept["a"]["job_type"] == ["contract"]


def test_broken_payloads_go_to_quarantine(spark):
    good = json.dumps({"jobs": [{"id": 1, "title": "A"}, {"id": 2}]})
    df = raw(spark, [("https://boards.greenhouse.io/acme", "Acme", good), ("https://boards.greenhouse.io/acme", "Acme", "{oops"), (None, None, None)])
    rows = careers_json.GREENHOUSE.parse(df).collect()
    assert [(r["id"], r["title"], r["job_url"]) for r in rows] == [("greenhouse:acme:1", "A", "https://boards.greenhouse.io/acme/jobs/1")]
    bad = {(r["seq"], r["pos"]): r["reason"] for r in careers_json.GREENHOUSE.quarantine(df).collect()}
    assert bad == {(0, 1): "missing field", (1, None): "unreadable payload", (2, None): "unreadable payload"}


def test_google_records_quarantine(spark):
    records = spark.createDataFrame([(1, 0, '["T","C",null,[["http://u"]]]'), (2, 0, "[oops"), (3, 0, '["T","C",null,[]]')], "seq bigint, pos int, record string")
    assert [r["job_url"] for r in boards_json.google_positional_job(records).collect()] == ["http://u"]
    assert {r["seq"]: r["reason"] for r in boards_json.google_quarantine(records).collect()} == {2: "unreadable payload", 3: "missing field"}


def test_description_formats(spark):
    page = json.dumps({"data": {"jobSearch": {"results": [{"job": {"key": "k", "title": "T", "description": {"html": "<p>a <b>b</b></p>"}}}]}}})
    df = raw(spark, [(None, None, page)])
    assert boards_json.INDEED.parse(df).first()["description"] == "a **b**"
    assert boards_json.INDEED.parse(df, ParseOptions(description_format="html")).first()["description"] == "<p>a <b>b</b></p>"
    with pytest.raises(ValueError):
        ParseOptions(description_format="pdf")


def test_free_form_json_rules(spark):
    items = [
        {"id": 7, "Name": "Staff Data Engineer", "Location": {"city": "Cork", "country": "IE"}, "link": "/j/1", "summary": "<b>Contract</b>", "type": ["Remote"], "date": 5, "posted_date": "2024-01-01"},
        {"id": "x", "name": "Blog", "city": "y"}, {"name": "Data Analyst"},
    ]
    body = json.dumps({"a": [{"jobs": items}]})
    df = raw(spark, [("https://c.test/careers", "Acme", f'<script id="__NEXT_DATA__">{{"props":{{"pageProps":{body}}}}}</script>')])
    rows = career_pages.parse_next_data(df).orderBy("pos").collect()
    first, second = rows
    assert (first["title"], first["job_url"], first["description"], first["is_remote"]) == ("Staff Data Engineer", "https://c.test/j/1", "**Contract**", True)
    assert (first["location"]["city"], first["location"]["country"]) == ("Cork", "IE")
    # The first date key decides, and it is a number here; a numeric id is no text either.
    assert first["date_posted"] is None and first["id"].startswith("custom:xhr:") and first["id"] != "custom:xhr:7"
    assert first["job_type"] == ["contract"] and second["job_url"] == "https://c.test/careers"


def test_post_lines(spark):
    text = "\n".join(["Feed post", "Jane Doe", "• 2nd", "CTO at Acme", "3d •", "We look for people", "Follow", "Apply now please", "Like", "9 comments"])
    df = raw(spark, [("u", None, text), ("u", None, "About us " * 10), ("u", None, "short")])
    rows = social.split_social_post_lines(df).collect()
    assert [(r["author"], r["subtitle"], r["time"], r["text"]) for r in rows] == [("Jane Doe", "CTO at Acme", "3d", "We look for people\nApply now please")]


def test_cascade_and_detail_pages(spark):
    ld = json.dumps([{"@type": ["JobPosting"], "title": "Linked", "url": "https://a.test/jobs/linked-one"}])
    links = '<a href="/jobs/one-two-three">One two three</a><a href="/jobs/four-five-six">Four five six</a>'
    pages = raw(spark, [
        ("https://a.test/careers", "A", f'<script type="application/ld+json">{ld}</script>{links}'), ("https://b.test/careers", "B", links),
        ("https://c.test/careers", "C", '<a href="/jobs/one-two-three">Only one link</a>'),
    ])
    text = "Good work " * 10
    detail = raw(spark, [("https://b.test/jobs/one-two-three", None, f'<meta name="description" content="{text}">')])
    rows = {(r["company_name"], r["title"]): r["description"] for r in careers.career_postings(pages, detail).collect()}
    assert rows == {("A", "Linked"): None, ("B", "One two three"): text.strip(), ("B", "Four five six"): None}


def mixed_pages(spark):
    """Pages with any of embedded state, linked data and links, in all combinations, and odd ones."""
    state = ('<script id="__NEXT_DATA__">{"props":{"pageProps":{"jobs":[{"id":"1","title":"Data Engineer","url":"/jobs/a","description":"<b>a</b>"},'
             '{"id":"2","title":"Site Engineer","url":"/jobs/b","workType":"Remote"},{"id":"3","title":"Head Cook","url":"/jobs/c"}]}}}</script>')
    menu = '<script id="__NEXT_DATA__">{"props":{"pageProps":{"items":[{"id":"1","name":"x"},{"id":"2","name":"y"},{"id":"3","name":"z"}]}}}</script>'
    linked = '<script type="application/ld+json">{"@type":"JobPosting","title":"Cook","description":"<i>c</i>","identifier":{"value":"7"}}</script>'
    untitled = '<script type="application/ld+json">{"@type":"JobPosting","title":""}</script>'
    links = '<a href="/jobs/one-two-three">One two three</a><a href="/jobs/four-five-six">Four five six</a>'
    one = '<a href="/jobs/one-two-three">One two three</a>'
    bodies = ["".join(p) for p in itertools.product(("", state, menu), ("", linked, untitled), ("", links, one))]
    rows = [(f"https://{i}.test/careers", "A", b) for i, b in enumerate(bodies)]
    same = [("https://same.test/careers", "A", b) for b in (links, state, linked)]
    return raw(spark, [*rows, *same, (None, "B", links + linked), (None, "B", linked), ("https://n.test/", "N", None), ("https://e.test/", "E", "")])


def test_page_cascade_is_the_best_of_all_strategies(spark):
    pages = mixed_pages(spark)
    every = careers.page_strategies(pages).withColumn("page", F.coalesce("source_url", F.col("seq").cast("string")))
    best = every.groupBy("page").agg(F.min("strategy_rank").alias("strategy_rank"))
    wanted = every.join(best, ["page", "strategy_rank"], "left_semi").drop("page", "strategy_rank")
    found = careers.career_postings(pages)
    assert found.schema == wanted.schema and found.count() > 40
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    assert {r[0] for r in career_pages.page_cascade(pages).select("strategy_rank").distinct().collect()} == {1, 2, 6}
    assert careers.career_postings(pages.limit(0)).count() == 0


def test_career_pages_are_scanned_once(spark):
    folder = work_folder(spark, "t-pages")
    mixed_pages(spark).write.parquet(folder)
    pages = spark.read.schema(RAW_DDL).parquet(folder)
    plan = careers.career_postings(pages)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1
    more = careers.career_postings(pages, platform_rows=postings(spark, [
        {"seq": 1, "title": "Own", "source_url": "https://2.test/careers"}, {"seq": 2, "title": "None", "source_url": "https://9.test/careers"},
    ]))
    assert [r["title"] for r in more.where("source_url like '%//2.test%'").collect()] == ["Own"]
    assert more.where("title = 'None'").count() == 0


def test_batch_equals_stream(spark):
    rows = [(f"https://boards.greenhouse.io/acme{i}", "Acme", json.dumps({"jobs": [{"id": i, "title": f"T{i}", "content": "$50k - $80k"}]})) for i in range(20)]
    df = raw(spark, rows)
    folder, path = work_folder(spark, "t-landed"), work_folder(spark, "t-out")
    df.write.parquet(folder)
    parse = careers_json.GREENHOUSE.parse
    stream = stream_normalize(read_landed(spark, folder, RAW_DDL), parse)
    write_available(stream, path, path + "-checkpoint")
    batch = assemble.flatten_postings(parse(df))
    streamed = spark.read.schema(batch.schema).parquet(path)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect())) and streamed.count() == 20


def test_stream_dedup_drops_repeats(spark):
    folder, path = work_folder(spark, "t-events"), work_folder(spark, "t-once")
    rows = spark.sql("SELECT id % 5 AS k, TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id AS int)) AS ts FROM range(100)")
    rows.repartition(4).write.parquet(folder)
    write_available(stream_dedup(read_landed(spark, folder, rows.schema), ["k"], "1 day"), path, path + "-checkpoint")
    assert spark.read.parquet(path).groupBy("k").count().where("count > 1").count() == 0
    assert spark.read.parquet(path).count() == 5


def test_cut_lineage_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark, "x") == f"{shared}/x"
    cut = cut_lineage(spark.range(5), "five")
    assert cut.count() == 5 and shared in cut.inputFiles()[0]


def test_clear_work_deletes_what_was_written(spark):
    import os

    path = cut_lineage(spark.range(3), "three").inputFiles()[0].removeprefix("file:")
    assert os.path.exists(path)
    clear_work(spark)
    assert not os.path.exists(path)


def test_odd_json_fails_no_job(spark):
    deep = '{"a":' * 20_000 + "1" + "}" * 20_000
    page = ('<script type="application/ld+json">%s</script><script type="application/ld+json">'
            '{"@type":"JobPosting","title":"Cook \\ud800","identifier":{"value":""},"url":"https://a.test/%d"}</script>')
    pages = raw(spark, [("https://a.test/jobs", "A", page % (deep, i)) for i in range(3)])
    found = career_pages.parse_jsonld_postings(pages).collect()
    assert [r["title"] for r in found] == ["Cook �"] * 3
    assert len({r["id"] for r in found}) == 3  # an empty identifier is no identifier
    bodies = pages.select("seq", "url", "company", F.lit(deep).alias("body"))
    assert career_pages.find_job_arrays(bodies).count() == 0
    google = raw(spark, [(None, None, "[[[" * 30_000), (None, None, None)])
    assert boards_json.parse_google_page(google).count() == 0


def test_rows_without_a_key_are_kept(spark):
    rows = postings(spark, [{"seq": i, "pos": 0, "site": "reed"} for i in range(5)])
    assert dedup.dedup_within_site(rows).count() == 5
    ranked = rows.withColumn("strategy_rank", F.lit(1))
    assert aggregates.strategy_cascade(ranked, ["job_url"]).count() == 5
    assert aggregates.min_support(rows, ["job_url"], 2).count() == 5
    none = rows.withColumn("seq", F.when(F.col("seq") > 0, F.col("seq")))
    assert {ranking.rows_per_group(none, n).count() for n in (5, 1000, 1001)} == {5}
    texts = spark.createDataFrame([(i, f"Now hiring a PHP developer number {i}, apply here please") for i in range(5)], "seq bigint, text string")
    posts = texts.select("seq", F.lit("a").alias("author"), F.lit("").alias("subtitle"), F.lit("").alias("time"), "text", F.lit(None).cast("string").alias("url"))
    assert dedup.dedup_within_site(social.parse_linkedin_posts(posts)).count() == 5


def test_pages_of_unknown_url_keep_their_postings(spark):
    body = '<script type="application/ld+json">{"@type":"JobPosting","title":"Cook"}</script>'
    pages = raw(spark, [(None, "A", body), (None, "B", body)])
    assert careers.career_postings(pages).count() == 2


def test_site_names():
    assert site_names(" LinkedIn") == ["linkedin"] and site_names(["SEEK", "greenhouse", "seek"]) == ["seek", "greenhouse"]
    assert len(site_names(None)) == 13
    for wrong in ("monster", ["indeed", "nowhere"]):
        with pytest.raises(ValueError):
            SearchSpec(site_name=wrong)


def test_unmatched_end_tags_cost_no_search():
    import time

    def seconds(n):
        start = time.process_time()
        scan_html("<div>" * n + "</b>" * n)
        return time.process_time() - start

    assert seconds(20_000) < 12 * max(seconds(4_000), 0.005)


def test_no_job_runs_while_a_plan_is_built(spark):
    body = '<script type="application/ld+json">{"@type":"JobPosting","title":"Cook"}</script>'
    pages = raw(spark, [("https://a.test/", "A", body)])
    tracker = spark.sparkContext.statusTracker()
    before = tracker.getJobIdsForGroup()
    careers.career_postings(pages)
    career_pages.parse_captured(pages.withColumn("response_url", F.col("url")))
    enrich_with_details(postings(spark, [{"seq": 1, "id": "a"}]), postings(spark, [{"seq": 1, "id": "a"}]))
    assert tracker.getJobIdsForGroup() == before


def test_a_dictionary_of_any_size_finds_the_first_and_longest_name(spark):
    import random
    import re

    rng = random.Random(7)
    parts = ["al", "be", "ça", "do", "e1", "fu", "st", "x"]
    names = {}
    while len(names) < 100_000:
        name = rng.choice(("", " ", "-", ". ")).join("".join(rng.choices(parts, k=rng.randint(1, 5))) for _ in range(rng.randint(1, 3)))
        names[name] = str(len(names) % 97)
    names |= {"d.c.": "dc", "new york": "ny", "new york city": "nyc", "new": "n"}
    known = list(names)
    texts = ["", None, "...", "New  York", "in NEW YORK CITY!", "in New York Cityx", "d.c.", "d.c.a", "(d.c.) new"]
    for _ in range(200):
        words = [rng.choice(known) if rng.random() < 0.3 else rng.choice(parts) + "q" for _ in range(rng.randint(1, 6))]
        texts.append(rng.choice((" ", ", ", "-", "")).join(words).title())

    def brute(text):
        low = (text or "").lower()
        edges = [m.start() for m in re.finditer(r"\b", low)]
        for start in edges:
            if low[start:start + 1].isalnum():
                hits = [low[start:end] for end in edges if end > start and low[start:end] in names]
                if hits:
                    return max(hits, key=len)
        return None

    table = spark.createDataFrame(list(names.items()) + [("New", "z")], "name string, value string")
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: (r.name, r.value) for r in first_names(df, table, ["id"]).collect()}
    want = {i: (brute(t), names[brute(t)]) for i, t in enumerate(texts) if brute(t)}
    assert got == want and len(want) > 100
    assert got[4] == ("new york city", "nyc") and got[5] == ("new york", "ny") and got[7] == ("d.c.", "dc") and 6 not in got
    assert first_names(df.where("false"), table, ["id"]).count() == 0
    with pytest.raises(Exception, match="more than 4 words"):
        first_names(df, table.unionByName(spark.createDataFrame([("a b c d e", "1")], table.schema)), ["id"]).collect()


def test_what_names_nothing_is_sifted_out_before_the_dictionary_join(spark):
    """all stretches of all texts went through the join's shuffle."""
    table = spark.createDataFrame([("new york", "ny"), ("cork", "ie")], "name string, value string")
    df = spark.createDataFrame([(i, "many words " * 5 + ("New York" if i == 3 else "x")) for i in range(50)], "id int, text string")
    found = first_names(df, table, ["id"])
    assert [tuple(r) for r in found.collect()] == [(3, "new york", "ny")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("scalar-subquery")


def test_a_cut_table_is_read_by_the_values_it_is_split_by(spark):
    """every site's parser opened the landed files of all sites."""
    df = spark.createDataFrame([(i, s, "p") for s in ("seek", "reed") for i in range(3)], "seq long, site string, payload string")
    back = cut_lineage(df, "landed", by=["site"])
    assert back.columns == df.columns and sorted(back.collect()) == sorted(df.collect())
    files = back.where(F.col("site") == "seek").select(F.input_file_name().alias("f")).distinct().collect()
    assert files and all("/site=seek/" in r.f for r in files)


def test_nodes_are_built_in_pieces_and_stay_the_same(monkeypatch):
    """the nodes of a whole batch of pages were Python objects at once."""
    import pyarrow as pa

    from vacancia.functions import markup

    pages = pa.array([f'<div class="a  b" id={i}><p>x &amp; {i}</p><br><script>1<2</script></div><i' for i in range(50)] + [None, ""])
    whole, sizes = markup.html_nodes.func(pages), []
    real = markup._node_arrays
    monkeypatch.setattr(markup, "_CHUNK", 10)
    monkeypatch.setattr(markup, "_REMEMBERED", 2)
    monkeypatch.setattr(markup, "_node_arrays", lambda p, *a: sizes.append(len(p)) or real(p, *a))
    assert markup.html_nodes.func(pages).to_pylist() == whole.to_pylist()
    assert len(sizes) > 10 and max(sizes) < 20


def test_post_lines_are_told_apart_without_expressions_per_line(spark):
    body = "We are looking for a cook\nin our kitchen"
    texts = [
        f"Feed post\nAnna\n• 2nd\nChef at Foo\n5 Д •\n{body}\n… SEE MORE\nſhare\nnot read",
        f"　 Follow \nBob\n\n12 mo\n Follow me on {body}\n3 Reactions\nnot read",
        "\n".join(["Cyd", *[f"line number {i}" for i in range(13)], "3d", "Like us", "Like"]),
        f"Anna\nTerms\n٣d\n{body} of the new town hall",
        f" ABOUT the company\n{body} {body}", "Anna\n3d\nshort\nLike\n" + "x" * 60, "", None,
    ]
    df = spark.createDataFrame([(i, None, t) for i, t in enumerate(texts)], "seq int, url string, payload string")
    posts = social.split_social_post_lines(df)
    got = {r.seq: (r.author, r.subtitle, r.time, r.text) for r in posts.collect()}
    assert got[0] == ("Anna", "Chef at Foo", "5 Д", body)
    assert got[1] == ("Bob", "", "12 mo", f"Follow me on {body}")
    assert got[2][:3] == ("Cyd", "line number 0", "") and got[2][3].endswith("line number 12\n3d\nLike us")
    assert got[3] == ("Anna", "Terms", "", texts[3]) and set(got) == {0, 1, 2, 3}
    assert "transform(" not in posts._jdf.queryExecution().optimizedPlan().toString()


def test_page_state_is_read_once(spark):
    page = '<script id="__NEXT_DATA__">{"props":{"pageProps":%s}}</script>'
    rows = [(1, "u", "c", page % '{"a":[1]}'), (2, "u", "c", page % '""'), (3, "u", "c", "<p>none</p>"), (4, "u", "c", None)]
    found = career_pages.next_data(spark.createDataFrame(rows, "seq int, url string, company string, payload string"))
    assert found.columns == ["seq", "url", "company", "body"]
    assert [tuple(r) for r in found.collect()] == [(1, "u", "c", '{"a":[1]}')]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("__NEXT_DATA__") == 1


def test_dedup_reads_its_input_once(spark):
    """Rows that arrive together: one of a key, all without a key."""
    rows = [(1, 0, "seek", "a"), (1, 0, "seek", "a"), (0, 0, "seek", "a"), (0, 0, "seek", "a"), (0, 0, "reed", "a"),
            (None, 0, "seek", "b"), (5, 0, "seek", "b"), (7, 0, "seek", None), (7, 0, "seek", None), (None, None, "seek", None)]
    df = as_postings(spark.createDataFrame(rows, "seq bigint, pos int, site string, id string"))
    got = dedup.dedup_within_site(df)
    assert got.columns == df.columns
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and plan.count("WindowGroupLimit") == 2
    found = sorted(str((r["seq"], r["site"], r["id"])) for r in got.collect())
    assert found == sorted(map(str, [
        (0, "seek", "a"), (0, "reed", "a"), (None, "seek", "b"), (7, "seek", None), (7, "seek", None), (None, "seek", None)]))


def test_a_json_payload_is_read_once(spark):
    df = boards_json.NAUKRI.parse(raw(spark, [(None, None, '{"jobDetails":[{"jobId":"1"},{"jobId":""}]}'), (None, None, "<")]))
    assert [r["id"] for r in df.select("id").collect()] == ["nk-1"]
    assert df.select("id")._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1


def test_payloads_of_other_sites_are_not_built(spark):
    base = spark.range(3).withColumn("company_name", F.lit("A")).withColumnRenamed("id", "seq")
    both = reduce(lambda a, b: a.unionByName(b), [
        inputs.raw(base, F.concat(F.lit(mark), F.col("seq").cast("string")), site) for site, mark in (("indeed", "<in>"), ("seek", "<sk>"))])
    one = both.where(F.col("site") == "seek")
    assert sorted(r["payload"] for r in one.collect()) == ["<sk>0", "<sk>1", "<sk>2"]
    # What is left of the other branch has no rows.
    assert one._jdf.queryExecution().executedPlan().toString().count("Range (") == 1


def test_linked_data_is_asked_once_for_each_field(spark):
    entries = [
        {"@type": "JobPosting", "title": "Cook", "url": "/job/dev-job7", "baseSalary": {"value": {"minValue": 10, "maxValue": None}}},
        {"@type": "JobPosting", "title": "Cook", "url": ""},
        {"@type": "JobPosting", "title": None, "url": "/job/x"},
        {"@type": "ListItem", "title": "no posting", "url": "/job/x"},
    ]
    listed = {"@type": "ItemList", "itemListElement": [{"item": {"title": "Baker", "url": "https://a.test/b", "datePosted": "2024-01-02"}}, entries[0]]}
    rows = [(None, None, f'<script type="application/ld+json">{json.dumps(body)}</script>') for body in (entries, listed)]
    df = boards_html.parse_irishjobs_jsonld(raw(spark, rows), ParseOptions(as_of="2024-02-15"))
    shown = df.select("seq", "pos", "id", "title", "job_url", "compensation.min_amount", F.col("date_posted").cast("string"))
    plan = shown._jdf.queryExecution().executedPlan().toString()
    assert plan.count("$.title") == plan.count("$.url") == plan.count("$.item)") == 1
    got = sorted(map(tuple, shown.collect()))
    assert [(g[0], g[1], g[3], g[5], g[6]) for g in got] == [
        (0, 0, "Cook", 10.0, None), (1, 0, "Baker", None, "2024-01-02"), (1, 1, "Cook", 10.0, None)]
    assert (got[0][2], got[0][4], got[1][4]) == ("ij-7", "https://www.irishjobs.ie/jobs/7", "https://a.test/b")


def test_pages_of_linkedin_are_read_where_they_are_scanned(spark):
    """No node of a page goes to Spark: its cards and fields do."""
    card = (
        '<DIV class=" x\tbase-search-card"><a class="base-card__full-link" href="/jobs/view/cook-7?a=1"><span class="sr-only"> Cook </span></a>'
        '<h4 class="base-search-card__subtitle"><b></b><a href="https://c.test/?trk=1"> A <i>&amp; B</i></a></h4>{}</div>'
    )
    meta = '<div class="base-search-card__metadata"><time class="job-search-card__listdate--new" datetime="2024-01-02">now</time></div>'
    pages = [card.format(meta) + '<div class="base-search-card">no link</div>' + card.format(""), None, "", "<p>"]
    cards = boards_html.parse_linkedin_cards(raw(spark, [(None, None, p) for p in pages]))
    shown = cards.select("seq", "pos", "id", "title", "company_name", "company_url", F.col("date_posted").cast("string"))
    label = '<h3 class="description__job-criteria-subheader">{}</h3><p><span class="{}">not beside it</span></p><span class="{}"> {} </span>'
    names = "description__job-criteria-text description__job-criteria-text--criteria"
    job = (
        '<div class="Show-More-less-html__markup"><b>Do</b></div>' + label.format("Seniority level", names, names, "Entry")
        + label.format("Employment type", names, names.split()[1], "Full-time") + label.format("Job function", names, names, "IT") + '<code id="applyUrl">'
    )
    details = boards_html.parse_linkedin_detail(raw(spark, [("https://l.test/view/7", None, p) for p in (job, None)]))
    for df in (shown, details):
        assert "html_nodes" not in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, shown.collect())) == [
        (0, 0, "li-7", "Cook", "A& B", "https://c.test/", "2024-01-02"), (0, 2, "li-7", "Cook", "A& B", "https://c.test/", None)]
    got = [(r["id"], r["description"], r["job_level"], r["job_type"], r["job_function"]) for r in details.orderBy("seq").collect()]
    assert got == [("li-7", "**Do**", "entry", [], "not beside it"), ("li-7", None, None, [], None)]


def test_pages_of_html_boards_are_read_where_they_are_scanned(spark):
    """No node of a page goes to Spark, neither for postings nor for details nor for what can't be read."""
    pages = [
        ("https://x.test/?jobid=1", None, '<LI data-js-job=""><h2> Cook <a href=" /j ">&amp; Co</a></h2><div class="t-mute  t-small">Cork</div></li><li data-js-job></li>'),
        ("https://x.test/?jobid=2", None, '<p><a href="/JobDetails/7">Smith</a><div class="x Org-name">Forge</div></p><div><span>Job Type</span><span>Full Time</span></div>'),
        ("https://x.test/?jobid=3", None, '<div data-testid="job-item"><a data-at="job-item-title" href="/job-a-job9">Baker</a><span class="the-job-type">Contract</span></div>'),
        ("https://x.test/?jobid=4", None, '<li class="list-group-item x"><b class="list-group-item-heading"><a href="/apply/k/r">Clerk</a></b><p><i class="fa-map-marker"></i> Cork </p></li>'),
        ("https://x.test/?jobid=5", None, '<div class="jobcontent"><h5>Your responsibilities</h5>to <p>do <b>it</b></p><ul><li>so</li></ul><hr><p>not this</p></div>'),
        ("https://x.test/?jobid=6", None, None),
    ]
    given = raw(spark, pages)
    parsers = (boards_html.parse_bayt, boards_html.parse_bdjobs_cards, boards_html.parse_irishjobs_cards, boards_html.parse_jazzhr)
    rows = [parse(given) for parse in parsers]
    details = [parse(given) for parse in (boards_html.parse_bdjobs_detail, boards_html.parse_seek_detail, boards_html.parse_ziprecruiter_detail, boards_html.parse_jazzhr_detail)]
    rejected = {name: listed(given) for name, listed in boards_html.HTML_QUARANTINE.items()}
    for df in (*rows, *details, *rejected.values()):
        assert "html_nodes" not in df._jdf.queryExecution().executedPlan().toString()
    got = [[(r["seq"], r["title"], r["job_url"], r["location"]["city"]) for r in df.collect()] for df in rows]
    assert got[:3] == [
        [(0, "Cook& Co", "https://www.bayt.com/j", "Cork")],
        [(1, "Smith", "https://jobs.bdjobs.com/JobDetails/7", "Dhaka")],
        [(2, "Baker", "https://www.irishjobs.ie/jobs/9", None)],
    ]
    assert [(seq, title, city) for seq, title, _, city in got[3]] == [(3, "Clerk", "Cork")]
    duties = details[0].orderBy("seq").select("id", "description", "job_type").collect()
    assert [tuple(r) for r in duties][1] == ("2", "", ["fulltime"]) and duties[4]["description"] == "do it\nso"
    assert [df.count() for df in details] == [len(pages)] * 4
    assert {name: df.where("reason = 'no posting read'").count() for name, df in rejected.items()} == {
        "linkedin": 6, "bayt": 5, "bdjobs": 5, "irish_jobs": 5, "jazzhr": 5}
    assert [tuple(r) for r in rejected["bayt"].where("pos is not null").collect()] == [(0, 1, "missing field", "{}")]


def test_rows_written_by_site_are_not_sorted_first(spark, tmp_path):
    """A task keeps a file open for each site; the session's own setting stays what it was."""
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(name)
    df = spark.range(60).selectExpr("id", "concat('s', id % 40) AS site")
    written = session.cut_lineage(df, "by-site", by=["site"])
    with session._writers(spark, session.OPEN_FILES):
        seen.append(spark.conf.get(name))
    assert seen == [str(session.OPEN_FILES)] and spark.conf.get(name) == before
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, df.collect()))


def test_the_largest_array_is_chosen_where_a_body_is_read(spark):
    """Only the items of one array leave the helper, and of them only what a posting is read from."""
    job = '{{"NAME": "{}", "title": "later", "uid": {}, "slug": "k", "Date": {}, "type": ["Remote"], "other": "x"}}'
    few = ",".join([job.format("Cook at sea", 1, 5), '{"name": "About us"}', "7"])
    many = ",".join(job.format(t, i, '"2024-01-02"') for i, t in enumerate(("Cook at sea", "Baker on land", "Blog")))
    tie = ",".join(job.format(t, 8, "null") for t in ("Third of all", "Fourth of all", "x"))
    bodies = ['{"a": [%s], "b": {"c": [%s]}, "d": [%s]}' % (few, many, tie), '{"a": [1, 2, 3]}', "<", None]
    rows = spark.createDataFrame([(i, "https://c.test/p", "co", b) for i, b in enumerate(bodies)], "seq bigint, url string, company string, body string")
    largest = career_pages.largest_job_array(rows)
    plan = largest._jdf.queryExecution().executedPlan().toString()
    assert "largest_items" in plan and "job_arrays" not in plan
    items = {r["seq"]: r["items"] for r in largest.collect()}
    assert [(i["title"], i["id"], i["date"], i["remote"], i["url"]) for i in items[0]] == [
        ("Cook at sea", "k", "2024-01-02", True, None), ("Baker on land", "k", "2024-01-02", True, None)]
    assert [items[n] for n in (1, 2, 3)] == [None] * 3
    assert [r["title"] for r in career_pages.parse_loose_job(career_pages.best_job_array(rows)).orderBy("pos").collect()] == ["Cook at sea", "Baker on land"]


def test_strategies_of_a_page_scan_it_once(spark):
    """All strategies of a page's HTML come out of one scan, each with what it finds alone."""
    jobs = ",".join('{"title": "%s", "id": 1, "city": "Cork"}' % t for t in ("Cook at sea", "Baker on land", "Smith in town"))
    html = (
        '<script id="__NEXT_DATA__" type="x">{"props":{"pageProps":{"a":[%s]}}}</script><script type="application/ld+json">'
        '{"@type": "JobPosting", "title": "Clerk"}</script><a href="/jobs/cook-wanted">Cook wanted</a><a href="/jobs/baker-wanted">Baker wanted</a>' % jobs
    )
    pages = raw(spark, [("https://c.test/p", "co", html), ("https://c.test/q", "co", "<p>"), ("https://c.test/r", "co", None)])
    every = careers.page_strategies(pages)
    plan = every._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1
    got = sorted((r["strategy_rank"], r["title"]) for r in every.collect())
    assert got == [(1, "Baker on land"), (1, "Cook at sea"), (1, "Smith in town"), (2, "Clerk"), (6, "Baker wanted"), (6, "Cook wanted")]
    alone = [career_pages.parse_next_data(pages), career_pages.parse_jsonld_postings(pages), career_pages.extract_job_links(pages)]
    for rank, df in zip((1, 2, 6), alone):
        assert sorted(map(str, every.where(F.col("strategy_rank") == rank).drop("strategy_rank").collect())) == sorted(map(str, df.collect()))


def test_a_title_is_looked_for_once_per_run_of_letters(spark):
    """A long run of words without a title costs one pass, not one for each of its letters."""
    texts = ["a " * 20_000 + "lead @", "x 🏢 Senior Engineer\nmore", "Öl Manager", "is Lead: İ Head Chef Manager"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", social_text.post_title(F.col("text")).alias("title"))
    started = time.monotonic()
    got = dict(map(tuple, df.collect()))
    assert time.monotonic() - started < 10
    assert got[1] == "Senior Engineer" and got[2] == "l Manager" and got[0].startswith("a a a")
