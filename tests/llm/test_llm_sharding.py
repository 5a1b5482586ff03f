"""Hilbert shards: the curve itself, the law, odd rows, and files that readers can skip."""

import itertools
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from test_llm_edges import CLASHES, DOCS, crowded
from vacancia.llm import hilbert


@pytest.mark.parametrize("axes,bits", [(2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_in_steps_of_one(axes, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    at = hilbert.curve_index(cells, bits)
    assert sorted(at.tolist()) == list(range(1 << axes * bits))
    steps = np.abs(np.diff(cells[np.argsort(at)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(11)
    rows = []
    for i in range(600):
        text = "the same text" if i % 3 == 0 else "w " * r.randrange(200) + "é"  # a third are copies
        rows.append((i, text, r.choice(["en", "de", None]), "hot" if i % 2 else f"s{i % 7}", len(text)))
    rows += [(None, None, None, None, None), (None, "", "en", "hot", 0), (7, "x", "en", "a", 1), (7, "x", "en", "a", 1), (900, "y" * 3000, "en", "a", 3000)]
    return spark.createDataFrame(rows, DOCS)


def test_shards_have_equal_bytes_and_gapless_slots(spark, docs):
    rows = hilbert.shard_documents(docs, shards=8).collect()
    texts = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == texts
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
        assert r.law == "bytes" and r.grown_shard is None
    total, largest = sum(r.size for r in rows), max(r.size for r in rows)
    assert sorted(by) == list(range(8))
    for found in by.values():
        assert sorted(r.slot for r in found) == list(range(len(found)))
        assert abs(sum(r.size for r in found) - total / 8) <= largest
    ordered = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in ordered] == sorted(r.curve for r in rows)
    # Equal texts of one place lie side by side.
    runs = [k for k, _ in itertools.groupby((r.curve, r.text_crc32) for r in ordered)]
    assert len(runs) == len(set(runs))


def test_shards_of_odd_tables(spark, docs):
    plain = sorted(map(repr, hilbert.shard_documents(docs, shards=8).collect()))
    assert plain == sorted(map(repr, hilbert.shard_documents(crowded(docs).repartition(5), shards=8).collect()))
    assert hilbert.shard_documents(docs.limit(0)).count() == 0
    alone = hilbert.shard_documents(docs, shards=3, dimensions=("n_chars",), bits=8).cache()
    assert alone.count() == 605 and alone.select("shard").distinct().count() == 3


def test_written_shards_hold_all_rows_in_narrow_files(spark, docs, tmp_path):
    path = str(tmp_path / "shards")
    more = crowded(docs)
    hilbert.write_shards(more, path, shards=8, file_bytes=4000)
    back = spark.read.schema(spark.read.parquet(path).schema).parquet(path)
    assert set(back.columns) == {*more.columns, "shard"} and len(CLASHES) > 5
    assert sorted(map(repr, back.select(*docs.columns).collect())) == sorted(map(repr, docs.collect()))
    want = {(r.doc_id, r.text_crc32): r.shard for r in hilbert.shard_documents(docs, shards=8).collect()}
    got = back.select("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")), "shard").collect()
    assert {(r[0], r[1]): r[2] for r in got} == want

    def read_for(files, **wanted):
        """Files that a reader can't skip, by their smallest and largest values."""
        kept = 0
        for f in files:
            m = pq.read_metadata(f)
            names = [m.schema.column(i).name for i in range(m.num_columns)]
            hit = True
            for c, v in wanted.items():
                s = [m.row_group(g).column(names.index(c)).statistics for g in range(m.num_row_groups)]
                hit &= any(x.has_min_max and x.min <= v <= x.max for x in s)
            kept += hit
        return kept / len(files)

    files = [str(f) for f in (tmp_path / "shards").rglob("*.parquet")]
    assert len(files) > 16
    by_id = tmp_path / "by_id"
    docs.repartitionByRange(len(files), "doc_id").write.parquet(str(by_id))
    plain = [str(f) for f in by_id.rglob("*.parquet")]
    for wanted in ({"source": "hot"}, {"source": "s2", "lang": "de"}, {"n_chars": 13}, {"n_chars": 300}):
        assert read_for(files, **wanted) < 0.8 * read_for(plain, **wanted)
