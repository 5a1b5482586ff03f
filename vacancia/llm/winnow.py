"""Benchmark decontamination by winnowed k-grams whose matches are extended word by word."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import hidden, keep, never_null, pick, shown

#: Words that a shared span must have to be found, whatever lies around it.
SPAN = 10
#: Bytes of text that are hashed at once, and the limits of the table that is sent to all tasks.
CHUNK_BYTES = 1 << 20
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_IS_WORD[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_NONE = np.uint64(2**64 - 1)


def k_and_w(span: int) -> tuple[int, int]:
    """k-gram length and window that find every shared span of ``span`` words: k + w - 1 = span."""
    k = (span + 1) // 2
    return k, span - k + 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """The words of some texts, as places in one byte array, with a 64-bit hash of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        word = _IS_WORD[data]
        self.low = _LOWER[data]
        n = len(data)
        first = word.copy()
        first[1:] &= ~word[:-1]
        last = word.copy()
        last[:-1] &= ~word[1:]
        inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < n)]
        first[inner] = word[inner]
        last[inner - 1] = word[inner - 1]
        self.starts, self.ends = np.nonzero(first)[0], np.nonzero(last)[0] + 1
        #: The words of text i are number bounds[i] up to bounds[i + 1].
        self.bounds = np.searchsorted(self.starts, offsets)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.bounds))
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.low * _powers(_BASE, n), out=sums[1:])
        raw = (sums[self.ends] - sums[self.starts]) * _powers(_INVERSE, n + 1)[self.starts]
        self.hashes = _mixed(raw + (self.ends - self.starts).astype(np.uint64) * _BASE)

    def selected(self, span: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of the k-grams that winnowing keeps: the least of any w in a row."""
        k, w = k_and_w(span)
        n = len(self.hashes)
        grams = n - k + 1
        windows = n - span + 1
        if windows <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        g = np.zeros(grams, dtype=np.uint64)
        for j in range(k):
            g = g * _BASE + self.hashes[j:j + grams]
        g = _mixed(g)
        least = g[:windows].copy()
        for j in range(1, w):
            np.minimum(least, g[j:j + windows], out=least)
        least[self.text[:windows] != self.text[span - 1:]] = _NONE  # reaches into another text
        kept = np.zeros(grams, dtype=bool)
        for j in range(w):
            kept[j:j + windows] |= (g[j:j + windows] == least) & (least != _NONE)
        where = np.nonzero(kept)[0]
        return where, g[where]

    def around(self, at: int, span: int) -> tuple[str, int]:
        """The words that any span through the k-gram at ``at`` can reach, and how many precede it."""
        k, _ = k_and_w(span)
        lo, hi = self.bounds[self.text[at]], self.bounds[self.text[at] + 1]
        left, right = max(lo, at - (span - k)), min(hi, at + span)
        low = self.low
        words = [low[self.starts[i]:self.ends[i]].tobytes().decode() for i in range(left, right)]
        return " ".join(words), int(at - left)


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows (from, to) with their bytes and offsets, of about ``CHUNK_BYTES`` each."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK_BYTES, "right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


_HITS = pa.struct([("span", pa.int32()), ("gram", pa.int64()), ("at", pa.int64()), ("words", pa.string()), ("before", pa.int32())])
_SCHEMA = "key {key}, text_hash long, n_words long, hits array<struct<span int, gram long, at long, words string, before int>>"


def _fingerprints(texts: DataFrame, spans: Sequence[int] | None, bits: np.ndarray | None) -> DataFrame:
    """Word counts and winnowed k-grams of (key, text, text_hash).

    ``spans`` None: each text is winnowed for its own length, ``SPAN`` at most. ``bits``: only grams
    whose place in this bit table is set are given.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.uint64(len(bits) * 8 - 1) if bits is not None else None
        for batch in batches:
            for lo, hi, data, offsets in _pieces(batch.column(1)):
                words = Words(data, offsets)
                counts = np.diff(words.bounds)
                rows: list[list[tuple]] = [[] for _ in range(hi - lo)]
                own = spans if spans is not None else sorted({min(SPAN, int(c)) for c in counts if c})
                for span in own:
                    where, grams = words.selected(span)
                    if mask is not None:
                        place = grams & mask
                        hit = (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 != 0
                        where, grams = where[hit], grams[hit]
                    for at, gram in zip(where.tolist(), grams.view(np.int64).tolist()):
                        row = int(words.text[at])
                        if spans is None and min(SPAN, int(counts[row])) != span:
                            continue
                        text, before = words.around(at, span)
                        rows[row].append((span, gram, at - int(words.bounds[row]), text, before))
                flat = [hit for hits in rows for hit in hits]
                columns = [pa.array(list(c), t) for c, t in zip(zip(*flat), [f.type for f in _HITS])] if flat else \
                    [pa.array([], f.type) for f in _HITS]
                ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
                hits = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, [f.name for f in _HITS]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo),
                     pa.array(counts.astype(np.int64)), hits],
                    ["key", "text_hash", "n_words", "hits"],
                )

    kind = texts.schema["key"].dataType.simpleString()
    return texts.select("key", "text", "text_hash").mapInArrow(run, _SCHEMA.format(key=kind))


def _bit_table(grams: DataFrame) -> np.ndarray:
    """A table with a bit for each gram (modulo its size), which Spark builds in blocks of 4 KB.

    It has 32 bits for each of the items' grams, and 16 MB at most. A larger benchmark makes it let
    more grams pass, which the join after it drops: the result is the same.
    """
    n = grams.count()
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (32 * max(n, 1) - 1).bit_length()))
    place = F.col("gram").bitwiseAND(size - 1)
    blocks = grams.select((place + 1).alias("p"))  # the functions count from 1
    blocks = blocks.groupBy(F.bitmap_bucket_number("p").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")
    )
    table = np.zeros(size // 8, dtype=np.uint8)
    for block, part in blocks.collect():  # size / 32768 rows at most
        at = (block - 1) * 4096
        table[at:at + 4096] |= np.frombuffer(bytes(part), dtype=np.uint8)[:size // 8 - at]
    return table


def _extended(pairs: DataFrame) -> DataFrame:
    """(row, item, lo, hi): the span around each meeting gram on which text and item agree, if long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, items, los, his = [], [], [], []
            columns = [batch.column(c).to_pylist() for c in ("row", "span", "at", "words", "before", "item", "item_words", "item_before")]
            for row, span, at, words, before, item, item_words, item_before in zip(*columns):
                ours, theirs = words.split(" "), item_words.split(" ")
                k, _ = k_and_w(span)
                if ours[before:before + k] != theirs[item_before:item_before + k]:
                    continue
                left = 0
                while left < min(before, item_before) and ours[before - left - 1] == theirs[item_before - left - 1]:
                    left += 1
                right = k
                while right < min(len(ours) - before, len(theirs) - item_before) and ours[before + right] == theirs[item_before + right]:
                    right += 1
                if left + right >= span:
                    rows.append(row)
                    items.append(item)
                    los.append(at - left)
                    his.append(at + right)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(items, pa.string()), pa.array(los, pa.int64()), pa.array(his, pa.int64())],
                ["row", "item", "lo", "hi"],
            )

    return pairs.mapInArrow(run, "row long, item string, lo long, hi long")


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, text_hash, n_words, n_hit, items, spans) for every document.

    A document word is hit inside any occurrence of 10 consecutive words of an item, or of a whole item
    of fewer words. Words are runs of 0-9, a-z (A-Z lower-cased) and non-ASCII characters. ``items``
    has the ids, as sorted strings, of the items with such an occurrence, and ``spans`` the hit words
    as (lo, hi) for each occurrence found.

    Documents and items keep the least k-gram hash of each window of k-grams, so that any shared span
    of that length has a kept gram in common; meetings are extended in both directions and count only
    if the words agree. Item lengths below 10 get a k and window of their own. Only grams in the items'
    bit table leave their document, with the words around them; texts aren't shuffled.

    Null and empty texts have no words and no hits. Repeated documents each have their row, and items
    with a null id are hit without being named. No items: no hits. No documents: no rows.
    """
    tests = pick(items, key=item_key, text=item_text).withColumn("text_hash", F.lit(0).cast("long"))
    marks = keep(
        _fingerprints(tests, None, None).select(F.col("key").cast("string").alias("item"), F.explode("hits").alias("h"))
        .select("item", "h.span", "h.gram", F.col("h.words").alias("item_words"), F.col("h.before").alias("item_before")),
        "items",
    )
    spans = sorted(r[0] for r in marks.select("span").distinct().collect())  # SPAN rows at most
    bits = _bit_table(marks.select("gram"))
    source = pick(docs, key=key, text=text).withColumn("text_hash", F.xxhash64("text"))
    # Numbers given before the write stay with their rows after it.
    found = keep(_fingerprints(source, spans, bits).withColumn("row", F.monotonically_increasing_id()), "grams")
    hits = found.where(F.size("hits") > 0).select("row", F.explode("hits").alias("h")).select("row", "h.*")
    agreed = _extended(hits.join(marks, ["span", "gram"]).select(
        "row", "span", "at", "words", "before", "item", "item_words", "item_before"
    ))
    each = F.struct("lo", "hi")
    merged = agreed.groupBy("row").agg(F.array_sort(F.collect_set(each)).alias("spans"),
                                       F.array_sort(F.collect_set("item")).alias("items"))
    words = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["lo"], s["hi"] - 1)))))
    none = F.array().cast("array<string>")
    return found.select("row", "key", "text_hash", "n_words").join(merged.withColumn("n_hit", words), "row", "left").select(
        F.col("key").alias(key), "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"), F.coalesce("spans", F.array().cast("array<struct<lo:long,hi:long>>")).alias("spans"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                      item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents without a hit, with all their columns."""
    names = docs.columns
    hit = contamination(docs, items, key, text, item_key, item_text).where("n_hit > 0")
    bad = hit.select(never_null(key).alias("k"), F.col("text_hash").alias("h")).distinct()
    df = hidden(docs)
    df = df.withColumn("k", never_null(f"in_{names.index(key)}")).withColumn("h", F.xxhash64(f"in_{names.index(text)}"))
    return shown(df.join(bad, ["k", "h"], "left_anti"), names)  # a hit follows from the text alone
