"""URL filters: exact membership of keys through cascades of Bloom filters."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia.llm.common import keep, pick

BITS_PER_KEY, HASHES = 8, 5
LEAST_BITS = 1 << 10
#: Bits of a level up to which a cascade is sent to all tasks; a longer list is joined instead.
MOST_BITS = 1 << 29
MOST_LEVELS = 60
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Allow or block a host, its subdomains, and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str = ""

    @property
    def key(self) -> str:
        return self.host + self.path


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(h: np.ndarray, g: np.ndarray, level: int, bits: int) -> np.ndarray:
    """The ``HASHES`` bits of each key in a level's filter: (keys, HASHES)."""
    first = _mixed(h + np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 % 2**64))
    step = _mixed(g ^ np.uint64(level)) | np.uint64(1)
    return (first[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) % np.uint64(bits)


@dataclass(frozen=True)
class Cascade:
    """Filters in turn of listed keys and of what falsely passed the filter before.

    A key that fails a filter of listed keys isn't listed; one that fails a filter of false positives
    is. What passes all belongs to the set that the last filter was made of. That is exact for every
    key of the universe that the cascade was built over.
    """

    levels: tuple[tuple[np.ndarray, int], ...]

    def passes(self, level: int, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        table, bits = self.levels[level]
        at = _places(h, g, level, bits)
        return ((table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)

    def contains(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        found = np.zeros(len(h), dtype=bool)
        left = np.arange(len(h))
        for level in range(len(self.levels)):
            ok = self.passes(level, h[left], g[left])
            if level % 2:
                found[left[~ok]] = True
            left = left[ok]
        if len(self.levels) % 2:
            found[left] = True
        return found


def _filter(keys: DataFrame, n: int, level: int) -> tuple[np.ndarray, int]:
    """A Bloom filter of (h, g); Spark sets the bits of each 4 KB block."""
    bits = max(LEAST_BITS, n * BITS_PER_KEY)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, g = (batch.column(c).to_numpy().view(np.uint64) for c in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(_places(h, g, level, bits).reshape(-1).view(np.int64) + 1)], ["p"])

    blocks = keys.select("h", "g").mapInArrow(places, "p long").groupBy(F.bitmap_bucket_number("p").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")
    )
    table = np.zeros(-(-bits // 8), dtype=np.uint8)
    for block, part in blocks.collect():  # bits / 32768 rows of 4 KB
        at = (block - 1) * 4096
        table[at:at + 4096] |= np.frombuffer(bytes(part), dtype=np.uint8)[:len(table) - at]
    return table, bits


def build_cascade(universe: DataFrame, listed: DataFrame, most_bits: int = MOST_BITS) -> Cascade | None:
    """A cascade over the distinct keys ``universe`` (key, h, g) for the keys ``listed`` (key).

    Only distinct keys are joined, once; each level then scans what the level before has left. None if
    a filter would need more than ``most_bits``. Keys listed twice, null, or absent from the universe
    change nothing.
    """
    size = universe.count()
    marked = keep(
        universe.join(listed.select("key").distinct().withColumn("listed", F.lit(True)), "key", "left")
        .select("h", "g", F.coalesce("listed", F.lit(False)).alias("listed")), "universe", size,
    )
    ours, others = marked.where("listed"), marked.where("not listed")
    levels: list[tuple[np.ndarray, int]] = []
    for level in range(MOST_LEVELS):
        n = ours.count()
        if not n:
            return Cascade(tuple(levels))
        if n * BITS_PER_KEY > most_bits:
            return None
        levels.append(_filter(ours, n, level))
        now, at = Cascade(tuple(levels)), level

        @F.pandas_udf("boolean")
        def passing(h, g, now=now, at=at):
            return pd.Series(now.passes(at, *(x.to_numpy(dtype=np.int64).view(np.uint64) for x in (h, g))))

        ours, others = keep(others.where(passing("h", "g")), "passing", size), ours
    raise ValueError("two keys have the same 128-bit hash")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://``: the host in lower case, and the path without query or fragment."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, pattern, 1), _UPPER, _LOWER), F.regexp_extract(text, pattern, 2)


def _keys(host: Column, path: Column, labels: int, lengths: Sequence[int]) -> Column:
    """All keys that a rule fitting the URL or a list can have: host endings of up to ``labels`` labels, with
    the beginnings of the path that are as long as some rule's path; and the host with its whole path."""
    parts = F.slice(F.reverse(F.split(host, r"\.", -1)), 1, labels)
    ends = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.reverse(F.slice(parts, F.lit(1), n)), "."))
    starts = [F.when(F.length(path) >= n, F.substring(path, 1, n) if n else F.lit("")) for n in lengths]
    starts = F.filter(F.array(*starts), lambda p: p.isNotNull())
    entry = lambda e, p: F.struct(
        F.concat(e, p).alias("key"), F.length(e).alias("host"),
        F.xxhash64(F.concat(e, p)).alias("h"), F.xxhash64(F.lit(1), F.concat(e, p)).alias("g"),
    )
    found = F.flatten(F.transform(ends, lambda e: F.transform(starts, lambda p: entry(e, p))))
    return F.array_append(found, entry(host, path))


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], listed: Sequence[str] | DataFrame, key: str = "page_id", url: str = "url",
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """(key, host, path, rule, verdict) for every page.

    A rule fits its host and all subdomains if the path starts with the rule's. The longest fitting
    rule decides (of equally long ones, that with the longer host); without one, a page is blocked if
    its host, a parent domain, or its host with its whole path is ``listed`` (texts, or a frame of
    ``key``), and else allowed.

    Rules and listed keys are looked up in Bloom filter cascades over all keys that the pages can ask
    for, so no page is shuffled or joined. A list too long for that is joined by key.

    A null URL, or one without ``://``, has an empty host and path, fits nothing and is allowed.
    Repeated pages are judged alike; no pages, no rows.
    """
    spark = pages.sparkSession
    sets = {v: _frame(spark, [r.key for r in rules if r.verdict == v]) for v in ("allow", "block")}
    sets["listed"] = listed if isinstance(listed, DataFrame) else _frame(spark, listed)
    lengths = sorted({0, *(len(r.path) for r in rules)})
    widest = sets["listed"].agg(F.max(F.size(F.split(F.substring_index("key", "/", 1), r"\.", -1)))).first()[0]
    labels = max([widest or 1, *(r.host.count(".") + 1 for r in rules)])
    host, path = host_and_path(F.col("url"))
    split = pick(pages, key=key, url=url).select("key", host.alias("host"), path.alias("path"))
    asked = split.withColumn("keys", _keys(F.col("host"), F.col("path"), labels, lengths))
    universe = keep(asked.select(F.explode("keys").alias("k")).select("k.key", "k.h", "k.g").distinct(), "keys", split.count())
    cascades = {name: build_cascade(universe, keys, most_bits) for name, keys in sets.items()}
    if any(c is None for c in cascades.values()):
        asked = _joined(asked, sets)
    else:
        asked = asked.withColumn("flags", _flags(list(cascades.values()))("keys.h", "keys.g"))
    hits = F.arrays_zip(F.col("keys").alias("k"), F.col("flags").alias("f"))
    fits = F.filter(hits, lambda x: x["f"].bitwiseAND(3) != 0)
    best = F.array_max(F.transform(fits, lambda x: F.struct(
        F.length(x["k"]["key"]).alias("n"), x["k"]["host"].alias("host"), x["k"]["key"].alias("key"),
        F.when(x["f"].bitwiseAND(1) != 0, "allow").otherwise("block").alias("verdict"),
    )))
    bad = F.exists("flags", lambda f: f.bitwiseAND(4) != 0)
    return asked.select("key", "host", "path", best.alias("best"), bad.alias("bad")).select(
        F.col("key").alias(key), "host", "path", F.col("best.key").alias("rule"),
        F.coalesce("best.verdict", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"),
    )


def _frame(spark: SparkSession, keys: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(k,) for k in keys], "key string")


def _flags(cascades: list[Cascade]):
    """A function of a row's key hashes: for each key, a bit for each cascade that has it."""

    @F.pandas_udf("array<int>")
    def look(h, g):
        sizes = h.map(len).to_numpy(dtype=np.int64)
        flat = [np.concatenate([np.asarray(x, dtype=np.int64) for x in s] or [np.zeros(0, np.int64)]).view(np.uint64) for s in (h, g)]
        flags = np.zeros(len(flat[0]), dtype=np.int32)
        for i, cascade in enumerate(cascades):
            flags |= cascade.contains(*flat).astype(np.int32) << i
        return pd.Series(np.split(flags, np.cumsum(sizes)[:-1]) if len(sizes) else [], dtype=object)

    return look


def _joined(asked: DataFrame, sets: dict[str, DataFrame]) -> DataFrame:
    """The same flags by a join of the pages' keys with the lists, for lists beyond any filter."""
    rows = keep(asked.withColumn("row", F.monotonically_increasing_id()), "asked")
    asks = rows.select("row", F.posexplode("keys").alias("at", "k")).select("row", "at", "k.key")
    flags = F.lit(0)
    for i, (name, keys) in enumerate(sets.items()):
        asks = asks.join(keys.select("key").distinct().withColumn(name, F.lit(1 << i)), "key", "left")
        flags = flags + F.coalesce(name, F.lit(0))
    found = asks.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", flags.alias("f")))).alias("x"))
    return rows.join(found.select("row", F.col("x.f").alias("flags")), "row", "left").withColumn(
        "flags", F.coalesce("flags", F.array().cast("array<int>"))
    )
