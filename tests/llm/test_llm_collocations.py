"""Collocations against counting in plain Python, the tries alone, and what doesn't fit into them."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from test_llm_edges import CLASHES, DOCS, crowded
from vacancia.llm import collocations as c


def lower(text):
    return "".join(x.lower() if x.isascii() else x for x in text)


def expected(rows, longest=3, least=10, top=2000, percent=50):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    inside = Counter()
    for (lang, words), a in found.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                key = lang, words[i:i + k]
                inside[key] = max(inside[key], a)
    scored = {}
    for (lang, words), a in found.items():
        if 100 * inside[lang, words] >= percent * a and inside[lang, words]:
            continue
        cuts = [(1000000 * a * a // (counts[lang, words[:j]] * counts[lang, words[j:]]), j) for j in range(1, len(words))]
        score, j = min(cuts)
        scored.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, words[:j]], counts[lang, words[j:]]))
    return sorted((lang, i + 1, phrase.decode(), -a, left, right, totals[lang], -score)
                  for lang, every in scored.items() for i, (score, a, phrase, left, right) in enumerate(sorted(every)[:top]))


def texts(n, seed):
    r = random.Random(seed)
    words = ["new", "york", "city", "café", "the", "in", "日本", "a\x00b", "#", "x" * 300, "İ", "ab", "abc"]
    marks = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", ";", " ", "\x1f"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(r.randrange(60)):
            parts += [r.choice(words[:r.randrange(2, 14)]), r.choice(marks)]
            if r.random() < 0.3:
                parts += ["New York", " ", "city", " "]
        rows.append((r.choice(["en", "de", "", None, "und", "x\ny"]), "".join(parts)))
    return rows


@pytest.fixture(scope="module")
def rows():
    return texts(150, 1) + [(None, None), ("en", ""), ("en", " .,\n"), ("en", "word"), ("fr", "une fois " * 3000), (None, "é" * 5000)] + texts(3, 2) * 3


def frame(spark, rows):
    return spark.createDataFrame([(i, text, lang, "a", 1) for i, (lang, text) in enumerate(rows)], DOCS)


def found(df, **given):
    return sorted(tuple(r) for r in c.collocations(df, **given).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("given", [{"top": 20}, {"longest": 4, "least": 3}])
def test_against_plain_python(spark, rows, given):
    want = expected(rows, **{k: v for k, v in given.items()})
    assert len(want) > 20 and found(frame(spark, rows), **given) == want


def test_small_chunks_little_memory_and_full_tables(spark, rows, monkeypatch):
    """Chunks of a few texts, counts and phrases given out again and again, bit tables that let nearly all pass."""
    for name, value in (("CHUNK_BYTES", 500), ("HELD", 50), ("LEAST_BITS", 8), ("MOST_BITS", 8)):
        monkeypatch.setattr(c, name, value)
    assert found(frame(spark, rows), least=3) == expected(rows, least=3)


def test_phrases_of_one_hash_go_to_the_tries(spark, rows, monkeypatch):
    plain = c.Chunk.hashes
    monkeypatch.setattr(c.Chunk, "hashes", lambda self, k, which=0: plain(self, k, which) & np.uint64(2**64 - 1 if which else 63))
    assert found(frame(spark, rows), least=3, most_phrases=0) == expected(rows, least=3)


def test_equal_first_hashes_are_told_apart(rows):
    """With one first hash for all, only the second tells phrases apart."""
    names, data = [r[0] or "und" for r in rows], [r[1] for r in rows]
    batch = pa.RecordBatch.from_arrays([pa.array(names), pa.array(data)], ["lang", "text"])
    chunk = next(c._chunks(iter([batch])))
    one, n = chunk.distinct(np.arange(len(chunk)), 1)
    chunk.hashes(1), chunk.hashes(1, 1)
    chunk._sums[0] = tuple(np.zeros_like(x) for x in chunk._sums[0])
    same, times = chunk.distinct(np.arange(len(chunk)), 1)
    text = [x.as_py() for x in chunk.texts(np.arange(len(chunk)), 1)]
    counted = Counter()
    for i, t in zip(same.tolist(), times.tolist()):
        counted[chunk.lang[i], text[i]] += t
    assert counted == Counter(zip(chunk.lang.tolist(), text)) and len(one) == len(counted) and n.sum() == len(chunk)


@pytest.mark.parametrize("limits", [(0, 128), (40, 10)])
def test_phrases_beyond_the_tries_are_counted_too(spark, rows, monkeypatch, limits):
    monkeypatch.setattr(c, "PHRASE_BYTES", limits[1])
    monkeypatch.setattr(c, "SLICE", 100)
    assert found(frame(spark, rows), least=3, most_phrases=limits[0]) == expected(rows, least=3)


def test_trie_takes_its_keys_and_no_others():
    r = random.Random(5)
    keys = sorted({tuple(r.randrange(400 if r.random() < 0.5 else 5) for _ in range(r.randrange(1, 6))) for _ in range(4000)})
    flat = np.array([s for k in keys for s in k])
    trie = c.DoubleArray.build(flat, c._offsets(keys))
    number = {k: i for i, k in enumerate(keys)}

    def value(key):
        state = np.zeros(1, dtype=np.int64)
        for s in key:
            state = trie.step(state, np.array([s]))
        return int(trie.value[state[0]]) if state[0] >= 0 else -1

    assert [value(k) for k in keys] == list(range(len(keys)))
    for _ in range(3000):
        key = tuple(r.randrange(-1, 500) for _ in range(r.randrange(1, 6)))
        assert value(key) == number.get(key, -1)
    assert (np.bincount(trie.check[trie.check >= 0]) >= 0).all()
    empty = c.DoubleArray.build(np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64))
    assert empty.step(np.zeros(2, dtype=np.int64), np.array([0, 3])).tolist() == [-1, -1]


def test_scores_beyond_64_bits(spark):
    """The products of counts of a billion are computed exactly."""
    from pyspark.sql import functions as F

    a, left, right = 3_000_000_000, 3_000_000_019, 4_000_000_007
    row = spark.range(1).select(F.lit(a).alias("a"), F.lit(left).alias("l"), F.lit(right).alias("r")).selectExpr(f"{c.SCORE} AS s").first()
    assert row.s == 1000000 * a * a // (left * right)


def test_odd_tables(spark, rows):
    df = frame(spark, rows)
    assert len(CLASHES) > 5 and found(crowded(df).repartition(7), longest=2) == expected(rows, longest=2)
    assert c.collocations(df.limit(0)).count() == 0
    assert c.collocations(frame(spark, [(None, None), ("en", "")])).count() == 0
