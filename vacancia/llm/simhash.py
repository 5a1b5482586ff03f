"""SimHash near-duplicates, found through a table of distances to reference fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vacancia.llm.common import chunks, hidden, keep, never_null, packed, pick, shown
from vacancia.llm.components import components

BITS = 64
#: Fingerprints of a bucket that one work unit compares with each other.
TILE = 4096


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 majority bits over the XXH64 (seed 42) of the text's word shingles, repeats included.

    A-Z are lower-cased; words are separated by space and \\x09-\\x0D; a text of fewer words is one
    shingle, and one without words has fingerprint zero.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, 42) for g in grams], dtype=">u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 65536):
        part = hashes[start:start + 65536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


@dataclass(frozen=True)
class Pivots:
    """Reference fingerprints for a distance table, and buckets read off that table.

    The bits form ``blocks`` blocks. Every random reference comes once as it is and once for each
    block with that block inverted; half the difference of two such distances, shifted, is the
    distance to the reference inside the block. Two fingerprints that differ in at most ``distance``
    bits agree in all but ``distance`` blocks at least, so they have the same in-block distances for
    some ``blocks - distance`` blocks: they meet in the bucket of these. The whole table then discards
    a pair if any two coordinates differ by more than ``distance`` (triangle inequality).
    """

    distance: int = 2
    blocks: int = 5
    references: int = 8
    seed: int = 2
    masks: tuple[int, ...] = field(init=False)
    table: np.ndarray = field(init=False, repr=False)

    def __post_init__(self) -> None:
        if not 0 <= self.distance < self.blocks:
            raise ValueError("there must be more blocks than differing bits")
        edges = np.linspace(0, BITS, self.blocks + 1).astype(int).tolist()
        masks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
        random = np.random.default_rng(self.seed).integers(0, 2**BITS, self.references, dtype=np.uint64, endpoint=False)
        rows = [random] + [random ^ np.uint64(m) for m in masks]
        object.__setattr__(self, "masks", tuple(masks))
        object.__setattr__(self, "table", np.stack(rows))

    def distances(self, prints: np.ndarray) -> np.ndarray:
        """Hamming distances to all references: (fingerprints, 1 + blocks, references)."""
        return np.bitwise_count(prints[:, None, None] ^ self.table[None]).astype(np.int8)

    def in_blocks(self, distances: np.ndarray) -> np.ndarray:
        """Distances inside each block, from those to a reference with and without it inverted."""
        widths = np.array([m.bit_count() for m in self.masks], dtype=np.int8)
        return (distances[:, :1] - distances[:, 1:] + widths[None, :, None]) // 2

    def buckets(self, prints: np.ndarray) -> np.ndarray:
        """A 64-bit bucket key per fingerprint and choice of blocks."""
        inside = self.in_blocks(self.distances(prints)).astype(np.uint64)
        codes = np.zeros(inside.shape[:2], dtype=np.uint64)
        for j in range(self.references):
            codes = codes * np.uint64(BITS + 1) + inside[:, :, j]
        keys = []
        for number, chosen in enumerate(combinations(range(self.blocks), self.blocks - self.distance)):
            key = np.full(len(prints), number + 1, dtype=np.uint64)
            for block in chosen:
                key = _mixed(key ^ codes[:, block])
            keys.append(key)
        return np.stack(keys, axis=1) if keys else np.zeros((len(prints), 0), dtype=np.uint64)

    def near(self, left: np.ndarray, right: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs at most ``distance`` bits apart. ``same``: both are one list, each pair once."""
        ours = self.distances(left).reshape(len(left), -1)
        theirs = ours if same else self.distances(right).reshape(len(right), -1)
        for start in range(0, len(left), 256):
            part = ours[start:start + 256]
            close = np.abs(part[:, None, 0] - theirs[None, :, 0]) <= self.distance
            if same:
                close &= np.arange(len(right))[None] > np.arange(start, start + len(part))[:, None]
            i, j = np.nonzero(close)
            for c in range(1, ours.shape[1]):
                if not len(i):
                    break
                stay = np.abs(part[i, c] - theirs[j, c]) <= self.distance
                i, j = i[stay], j[stay]
            i += start
            stay = np.bitwise_count(left[i] ^ right[j]) <= self.distance
            yield i[stay], j[stay]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _roots(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each index reaches over the pairs."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(key, text_hash, fp) for every row; ``fp`` holds the 64 bits as a signed long."""
    source = pick(docs, key=key, text=text).withColumn("text_hash", F.xxhash64("text"))
    schema = f"key {source.schema['key'].dataType.simpleString()}, text_hash long, fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            bits = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(bits.view(np.int64))], ["key", "text_hash", "fp"]
            )

    return source.mapInArrow(run, schema)


def _star(prints: np.ndarray, pivots: Pivots, cut: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links from each fingerprint to the smallest-numbered one that it reaches in its work unit.

    With ``cut`` the unit is a pair of slots, the first of which has so many, and only pairs across
    them are compared.
    """
    if cut is None:
        found = list(pivots.near(prints, prints, True))
    else:
        found = [(i, j + cut) for i, j in pivots.near(prints[:cut], prints[cut:], False)]
    i, j = (np.concatenate(x) if found else np.zeros(0, dtype=np.int64) for x in (zip(*found) if found else ((), ())))
    roots = _roots(len(prints), i, j)
    tied = np.nonzero(roots != np.arange(len(prints)))[0]
    return prints[tied].view(np.int64), prints[roots[tied]].view(np.int64)


def _runs(batches: Iterator[pa.RecordBatch], unit: list[str], most: int) -> Iterator[list[np.ndarray]]:
    """The columns of each work unit of sorted rows, units of one row left out.

    No more than ``most`` + 1 rows of a unit are held: of a larger one only its beginning is given.
    """
    rest: list[np.ndarray] | None = None
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in range(batch.num_columns)]
        if rest is not None:
            columns = [np.concatenate(x) for x in zip(rest, columns)]
        changed = np.zeros(max(0, len(columns[0]) - 1), dtype=bool)
        for c in range(len(unit)):
            changed |= columns[c][1:] != columns[c][:-1]
        ends = np.append(np.nonzero(changed)[0] + 1, len(columns[0]))
        starts = np.append(0, ends[:-1])
        for lo, hi in zip(starts[:-1][np.diff(starts) > 1], ends[:-1][np.diff(starts) > 1]):
            yield [x[lo:min(hi, lo + most + 1)] for x in columns]
        # The last unit may go on in the next batch.
        rest = [x[starts[-1]:starts[-1] + most + 1].copy() for x in columns]
    if rest is not None and len(rest[0]) > 1:
        yield rest


def near_links(distinct: DataFrame, pivots: Pivots, tile: int = TILE) -> DataFrame:
    """(a, b) for distinct fingerprints ``fp``: links that connect what lies near in some bucket.

    Buckets are streamed in their order. Within one, what is connected gets a star of links instead of
    all pairs. A bucket of more than ``tile`` fingerprints is only noted there; all noted ones are then
    cut into slots, and each pair of slots is a work unit of its own, so no task holds more than two
    slots at a time and no pair is left out.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 8192):
            prints = batch.column(0).to_numpy().view(np.uint64)
            keys = pivots.buckets(prints)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(prints, keys.shape[1]).view(np.int64))],
                ["bucket", "fp"],
            )

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, fp in _runs(batches, ["bucket"], tile):
            if len(fp) > tile:
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array(bucket[:1])], ["a", "b", "large"])
                continue
            a, b = _star(fp.view(np.uint64), pivots)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())], ["a", "b", "large"])

    rows = distinct.select("fp").mapInArrow(keyed, "bucket long, fp long")
    dealt = rows.repartition("bucket").sortWithinPartitions("bucket")
    # What is found is small: a shuffle of it spares a file for each task that looked.
    near = dealt.mapInArrow(linked, "a long, b long, large long")
    found = keep(near.repartition(distinct.sparkSession.sparkContext.defaultParallelism), "near")
    links = found.where("large is null").select("a", "b")
    large = found.where("large is not null").select(F.col("large").alias("bucket"))
    if large.isEmpty():
        return links

    held = rows.join(large, "bucket")
    sizes = held.groupBy("bucket").agg(F.ceil(F.count("*") / tile).cast("long").alias("slots"))
    slot = F.pmod(F.xxhash64("fp"), F.col("slots"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1))
    unit = ["bucket", "low", "high"]
    units = (
        held.join(sizes, "bucket").withColumn("slot", slot).withColumn("other", other)
        .select("bucket", F.least("slot", "other").alias("low"), F.greatest("slot", "other").alias("high"), "slot", "fp")
    )

    def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Slots follow from a hash, so a unit has about two tiles of rows.
        for _, low, high, slot, fp in _runs(batches, unit, 1 << 62):
            first = slot == low
            prints = np.concatenate([fp[first], fp[~first]]).view(np.uint64)
            a, b = _star(prints, pivots, None if low[0] == high[0] else int(first.sum()))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return links.unionByName(units.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(crossed, "a long, b long"))


def near_groups(prints: DataFrame, pivots: Pivots | None = None) -> DataFrame:
    """(fp, root, component_id) for each distinct ``fp`` of ``prints`` (key, fp, ...).

    Fingerprints link at ``pivots.distance`` or fewer differing bits; ``root`` is the smallest
    fingerprint and ``component_id`` the smallest key that a fingerprint reaches over links. Equal
    fingerprints are one before anything is compared.
    """
    pivots = pivots or Pivots()
    first = keep(prints.groupBy("fp").agg(F.min("key").alias("least")), "fingerprints", prints.count())
    tied = components(near_links(first, pivots), first.count())
    members = tied.unionByName(tied.select(F.col("root").alias("node"), "root").distinct())
    known = members.join(first, members["node"] == first["fp"]).select("fp", "root", "least")
    lowest = known.groupBy("root").agg(F.min("least").alias("lowest"))
    named = known.join(lowest, "root").select("fp", "root", "lowest")
    every = first.join(named, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("lowest", "least").alias("component_id")
    )
    # Written, so that joins of documents with it have nothing below but a shuffle that can be split.
    return keep(every, "groups", prints.count())


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, pivots: Pivots | None = None,
) -> DataFrame:
    """(key, text_hash, fingerprint, component_id), one row per document.

    A null or empty text has fingerprint zero and links like any other. Repeated rows come repeated. A
    null key never names a component unless all its members' keys are null. An empty table gives an
    empty result.
    """
    prints = keep(fingerprints(docs, key, text, shingle), "prints")
    groups = near_groups(prints, pivots)
    named = prints.join(groups, "fp").select(
        F.col("key").alias(key), "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
    return packed(named, prints.count())


def drop_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, pivots: Pivots | None = None,
) -> DataFrame:
    """One document of each group, the one with the smallest key (null last), with all its columns.

    Rows that have the smallest key in common are told apart by the hash of their text; of rows that
    have both in common, the one with the smallest hash of all columns (maps aside) stays.
    """
    names = docs.columns
    prints = keep(fingerprints(docs, key, text, shingle), "prints")
    order = F.struct(F.col("key").isNull().alias("n"), F.col("key").alias("k"), F.col("text_hash").alias("h"))
    chosen = (
        prints.groupBy("fp").agg(F.min(order).alias("o")).join(near_groups(prints, pivots), "fp")
        .groupBy("root").agg(F.min("o").alias("o")).select(never_null("o.k").alias("k"), F.col("o.h").alias("h"))
    )
    df = hidden(docs)
    df = df.withColumn("k", never_null(f"in_{names.index(key)}")).withColumn("h", F.xxhash64(f"in_{names.index(text)}"))
    every = [F.col(f.name) for f in hidden(docs).schema if "map<" not in f.dataType.simpleString()]
    once = Window.partitionBy("k", "h").orderBy(F.xxhash64(*every), F.xxhash64(F.lit(1), *every))
    kept = df.join(chosen, ["k", "h"], "left_semi").withColumn("r", F.row_number().over(once))
    return shown(kept.where("r = 1"), names)
