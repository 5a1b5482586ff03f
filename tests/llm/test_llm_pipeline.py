"""The pipeline against the same five steps in plain Python and SQL."""

from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import duck
from test_llm_edges import CLASHES, brute_hits, brute_words, crowded
from test_llm_queries import groups
from vacancia.llm import quality, queries, simhash

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def kept_by_rules(text):
    return all(not r.rejects(quality.Document(text)) for r in quality.RULES)


def without_boilerplate(rows):
    def bare(line):
        return line.strip(" \t\n\x0b\x0c\r")

    pages, seen = Counter(r[3] for r in rows), Counter()
    for r in rows:
        seen.update({(r[3], bare(x)) for x in r[1].split("\n") if bare(x)})
    bad = {k for k, n in seen.items() if n >= 2 and n > 0.01 * pages[k[0]]}

    def cleaned(host, text):
        filled = [x for x in text.split("\n") if bare(x)]
        if sum((host, bare(x)) in bad for x in filled) > 0.5 * len(filled):
            return text
        return "\n".join(x for x in text.split("\n") if (host, bare(x)) not in bad)

    return [(r[0], cleaned(r[3], r[1]), *r[2:]) for r in rows]


def test_pipeline_against_plain_python(spark):
    con = duck(SF)
    rows = con.execute("SELECT doc_id, text, lang, source, n_chars FROM documents").fetchall()
    rows = [(*r[:4], len(r[1])) for r in without_boilerplate([r for r in rows if kept_by_rules(r[1])])]
    roots = groups({r[0]: simhash.fingerprint(r[1]) for r in rows})
    rows = [r for r in rows if roots[r[0]] == r[0]]
    items = [(str(k), brute_words(t)) for k, t in con.execute("SELECT item_id, text FROM benchmark").fetchall()]
    rows = [r for r in rows if not brute_hits(brute_words(r[1]), items)[1]]
    frame = pd.DataFrame(rows, columns=COLUMNS)
    con.execute("DROP VIEW documents")
    con.register("documents", frame)
    copies = dict(con.execute(f"SELECT doc_id, copies FROM ({queries.OP1_SQL})").fetchall())
    want = sorted(r for r in rows for _ in range(copies[r[0]]))
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == COLUMNS
    assert sorted(tuple(r) for r in got.collect()) == want
    assert sum(n == 0 for n in copies.values()) and max(copies.values()) == 2


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_odd_tables(spark, name, stage):
    """Nulls everywhere, empty texts, repeated rows, no rows, and columns named like the operators' own."""
    long = " ".join(f"w{i}" for i in range(30_000))
    words = " ".join(f"word{i}" for i in range(80))
    rows = [
        (1, words, "en", "a", 1), (1, words, "en", "a", 1), (None, words + " x", None, None, None), (2, None, "en", "a", None),
        (3, "", "en", "a", 0), (4, long, "en", "b", 1), (5, " \n\n ", "en", "b", 1), (None, None, None, None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = stage(spark, docs, SF)
    assert found.columns[:5] == COLUMNS
    assert {r.doc_id for r in found.collect()} <= {1, 2, 3, 4, 5, None}
    more = stage(spark, crowded(docs), SF)
    assert more.columns == crowded(docs).columns and len(CLASHES) > 5
    assert sorted(map(repr, more.select(*COLUMNS).collect())) == sorted(map(repr, found.collect()))
    assert stage(spark, docs.limit(0), SF).count() == 0
    assert stage(spark, docs.where(F.col("text").isNull()), SF).count() <= 4
