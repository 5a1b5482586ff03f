"""Spelling variants against all pairs in plain Python, and in work units of every shape."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_llm_edges import DOCS, crowded
from vacancia.llm import queries, spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def expected(counts):
    words = sorted(counts)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    rows = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return rows


def made(n, seed, letters="abcé", low=1, high=9):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.randrange(low, high))): r.choice([3, 4, 7, 10, 30, 100]) for _ in range(n)}


def frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def found(spark, counts):
    return sorted(tuple(r) for r in spelling.spelling_forms(frame(spark, counts)).collect())


@pytest.mark.parametrize("chars,leaf", [(1 << 18, 64), (400, 2)])
def test_against_all_pairs(spark, monkeypatch, chars, leaf):
    """Few letters make many near words, anagrams and equal vectors; small units make layouts, tiles and local trees."""
    monkeypatch.setattr(spelling, "UNIT_CHARS", chars)
    monkeypatch.setattr(spelling, "LEAF", leaf)
    counts = made(600, 1) | made(200, 2, "abcdefghijklmnopqrstuvwxyzéèçüß", 4, 8)
    counts |= {w[:2] + "x" + w[3:]: 2 + i % 60 for i, w in enumerate(sorted(counts)[::3]) if len(w) > 3}
    assert found(spark, counts) == expected(counts)


def test_layout_of_a_small_sample_loses_nothing(spark, monkeypatch):
    """A layout of about 20 words; and one vector for a third of all words, which is dealt into tiles."""
    monkeypatch.setattr(spelling, "SAMPLE_WORDS", 20)
    monkeypatch.setattr(spelling, "UNIT_CHARS", 300)
    r = random.Random(4)
    counts = {"".join(r.sample("abcdefg", 7)): 5 + i % 50 for i in range(150)} | made(200, 5, "abcdefg", 6, 9)
    assert found(spark, counts) == expected(counts)


def test_long_words_other_scripts_and_folded_letters(spark):
    long = "ab" * 6000
    counts = {long: 50, long + "c": 9, long[:5000] + "x" + long[5001:]: 20, "слово": 40, "словo": 4, "слoво": 3, "日本語テ": 9, "日本語": 30,
              "x\U0001f600y": 5, "xy": 50, chr(97 + 38 * 5) + "aa": 6, chr(97 + 38 * 6) + "aa": 60}
    assert found(spark, counts) == expected(counts)


def test_every_query_reaches_its_neighbours():
    """Whatever the splits, a leaf that holds a near vector is reached."""
    r = np.random.default_rng(1)
    points = r.integers(0, 4, (3000, 12))
    members = []
    tree = spelling.Tree()
    tree.grow(points, np.arange(len(points)), 8, members)
    at = np.empty(len(points), dtype=int)
    for leaf, rows in enumerate(members):
        at[rows] = leaf
    assert tree.leaves == len(members) and sorted(np.concatenate(members).tolist()) == list(range(len(points)))
    shift = np.zeros_like(points)
    shift[np.arange(3000), r.integers(0, 12, 3000)] += 1
    for more, fewer, asked in ((1, 0, points - shift), (0, 1, points + shift), (1, 1, points - shift + np.roll(shift, 1, axis=0))):
        hit = np.zeros(3000, dtype=bool)
        visits = 0
        for leaf, rows in tree.reached(asked, more, fewer):
            hit[rows[at[rows] == leaf]] = True
            visits += len(rows)
        assert hit.all() and visits < 0.5 * 3000 * tree.leaves


def test_roots_follow_long_chains(spark):
    words = [chr(97 + i) * 4 for i in range(20)]
    forms = spark.createDataFrame(list(zip(words, words[1:])), "word string, form string")
    assert {r.word: r.root for r in spelling._roots(forms, 19).collect()} == {w: words[-1] for w in words[:-1]}


def test_odd_tables(spark):
    rows = [(1, "Maison maison MAISON maisons maisons maisons mäison", "fr", "a", 1), (None, "maison", None, None, None), (2, None, "fr", "a", 1),
            (3, "", "fr", "a", 1), (4, "maison x maison", "fr", "a", 1), (4, "maison x maison", "fr", "a", 1), (5, "É École école éCOLE école", "fr", "a", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    words = spelling.vocabulary(docs, least_count=1)
    assert {r.word: r.n for r in words.collect()} == {"maison": 8, "maisons": 3, "mäison": 1, "École": 1, "école": 2, "école": 2, "écolE".lower(): 3}
    got = sorted(map(repr, spelling.spelling_forms(words).collect()))
    more = spelling.vocabulary(crowded(docs), least_count=1).withColumn("near", F.lit(1))
    more = more.unionByName(spark.createDataFrame([(None, 5, 1), ("", 7, 1)], "word string, n long, near int"))
    assert got == sorted(map(repr, spelling.spelling_forms(more).collect()))
    assert spelling.spelling_forms(spelling.vocabulary(docs.limit(0))).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_forms(words, ratio=1.0)


def test_op12_vocabulary_by_plain_python(spark):
    import re

    sf, words = "/root/testdata/sf0.001", Counter()
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            at = h % len(run)
            words[run[:at] + run[at + 1:] if h % 97 == 0 else run] += 1
    counts = {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}
    assert sorted(tuple(r) for r in queries.QUERIES["op12_spelling_variants"](spark, sf).collect()) == expected(counts)
