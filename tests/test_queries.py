"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks import load
from checks.compare import compare, duck
from checks.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"

load()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, SF, name, QUERIES[name], ORACLES.get(name))
    assert ok, note


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 1500 and len(df.columns) == 34


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_quarantine_lists_the_real_rows_that_cannot_be_read(spark, monkeypatch):
    """Landed payloads that are no JSON, by Python's own parser, and no others; the query's plan keeps all rows."""
    import json

    from checks import jobs

    def readable(payload):
        try:
            json.loads(payload)
        except ValueError:
            return False
        return True

    sites = ("indeed", "zip_recruiter", "naukri", "seek", "reed", "greenhouse", "lever", "ashby", "workable", "bamboohr")
    landed, found = jobs.quarantined(spark, "/root/testdata/sf0.001")
    bad = found.where(found.site.isin(*sites)).where("seq >= 0 and reason = 'unreadable payload'")
    got = {(r.site, r.seq) for r in bad.select("site", "seq").collect()}
    rows = landed.select("site", "seq", "payload").where(landed.site.isin(*sites)).collect()
    want = {(r.site, r.seq) for r in rows if not readable(r.payload)}
    assert want and got == want
    monkeypatch.setattr(jobs, "quarantined", lambda *_: (landed, found))
    plan = jobs.quarantine_every_site(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Filter" in x and "< 0" in x]
