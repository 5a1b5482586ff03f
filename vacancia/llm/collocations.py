"""Phrase collocations, counted by double-array tries of the phrases that can be frequent enough."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancia.llm.common import keep, pick

UNKNOWN = "und"
#: Bytes of text that are gone through at once, and n-grams that are held before their counts are given out.
CHUNK_BYTES, HELD = 1 << 20, 1 << 21
#: Limits of what is sent to all tasks: bits of a table of hashes, phrases of the tries and bytes of each.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27
MOST_PHRASES, PHRASE_BYTES = 1 << 17, 128
#: Splits of the texts that one task looks through for phrases, at most.
SPLITS = 4
#: Bytes of a trie that come to the driver in one row.
SLICE = 1 << 22

#: The score of a cut from the counts of the whole and its parts, exact for counts of up to 15 digits.
SCORE = "cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * 1000000 div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.full(256, _WORD, dtype=np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
#: What follows a word in a chunk: another word of its piece, or none.
GOES_ON, ENDS = 0x20, 0x0A
_BASES = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Chunk:
    """The words of some texts: lower-cased bytes in which each word is followed by one mark.

    The mark says whether the next word belongs to the same piece of the same text. Word i is
    ``data[starts[i]:ends[i]]``; ``lang`` is the number of its language among ``langs``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: list[str], lang: np.ndarray) -> None:
        low = np.insert(_LOWER[data], offsets[1:], ENDS)
        kind = _KIND[low]
        word = kind == _WORD
        starts = np.nonzero(word & ~np.concatenate([[False], word[:-1]]))[0]
        ends = np.nonzero(~word & np.concatenate([[False], word[:-1]]))[0]
        breaks = np.cumsum(kind == _BREAK, dtype=np.int64)
        self.last = np.ones(len(starts), dtype=bool)
        self.last[:-1] = breaks[starts[1:]] > breaks[ends[:-1] - 1]
        low[ends] = np.where(self.last, ENDS, GOES_ON)
        word[ends] = True
        self.data = low[word]
        sizes = ends - starts
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        text_ends = offsets[1:] + np.arange(1, len(offsets))
        self.langs, self.lang = langs, lang[np.searchsorted(text_ends, starts, "right")]
        self._seeds = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big") for x in langs], dtype=np.uint64)
        self._sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __len__(self) -> int:
        return len(self.starts)

    def whole(self, k: int) -> np.ndarray:
        """Which of the runs of k words that begin at each word (but the last k - 1) lie in one piece."""
        n = max(0, len(self) - k + 1)
        ok = np.ones(n, dtype=bool)
        for j in range(k - 1):
            ok &= ~self.last[j:j + n]
        return ok

    def hashes(self, k: int, which: int = 0) -> np.ndarray:
        """A 64-bit hash of language and words for each run of k words, whole or not."""
        if which not in self._sums:
            base = _BASES[which]
            sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum((self.data + np.uint64(1)) * _powers(base, len(self.data)), out=sums[1:])
            self._sums[which] = sums, _powers(np.uint64(pow(int(base), -1, 1 << 64)), len(self.data) + 1)
        sums, inverse = self._sums[which]
        n = max(0, len(self) - k + 1)
        start, end = self.starts[:n], self.ends[k - 1:k - 1 + n]
        raw = (sums[end] - sums[start]) * inverse[start]
        return _mixed(raw + (end - start).astype(np.uint64) * _BASES[1 - which] ^ self._seeds[self.lang[:n]])

    def texts(self, at: np.ndarray, k: int) -> pa.Array:
        """The runs of k words from the words ``at`` on, as strings."""
        start, size = self.starts[at], self.ends[at + k - 1] - self.starts[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(ends[-1]) + np.repeat(start - ends[:-1], size)
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(self.data[place])).cast(pa.string())

    def names(self, at: np.ndarray) -> pa.Array:
        """The languages of the words ``at``."""
        return pa.array(self.langs, pa.string()).take(pa.array(self.lang[at]))

    def distinct(self, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the runs of k words at ``at``: one of each, and how often it is there.

        Equal hashes are compared by a second hash; what differs in it stays apart.
        """
        first, again = self.hashes(k)[at], self.hashes(k, 1)[at]
        _, one, group, n = np.unique(first, return_index=True, return_inverse=True, return_counts=True)
        other = again != again[one][group]
        n = n - np.bincount(group[other], minlength=len(n))
        return np.concatenate([at[one], at[other]]), np.concatenate([n, np.ones(int(other.sum()), dtype=n.dtype)])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """Chunks of about ``CHUNK_BYTES`` of rows (lang, text); a longer text is a chunk of its own."""
    for batch in batches:
        names = batch.column(0).dictionary_encode()
        langs, lang = names.dictionary.to_pylist(), names.indices.to_numpy(zero_copy_only=False)
        column = batch.column(1).cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
        lo = 0
        while lo < len(column):
            hi = min(len(column), max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK_BYTES, "right")) - 1))
            chunk = Chunk(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], langs, lang[lo:hi])
            if len(chunk):
                yield chunk
            lo = hi


def _texts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return pick(docs, lang=lang, text=text).select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, phrase, a) for all words of (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            at, n = chunk.distinct(np.arange(len(chunk)), 1)
            yield pa.RecordBatch.from_arrays([chunk.names(at), chunk.texts(at, 1), pa.array(n)], ["lang", "phrase", "n"])

    found = texts.mapInArrow(run, "lang string, phrase string, n long")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("a"))


def bit_table(hashes: DataFrame) -> np.ndarray:
    """A table with a bit for each number of ``gram`` (modulo its size), which Spark builds in blocks of 4 KB.

    It has 32 bits for each number and 16 MB at most; beyond, more others pass, and nothing is missed.
    """
    n = hashes.count()
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (32 * max(n, 1) - 1).bit_length()))
    place = (F.col("gram").bitwiseAND(size - 1) + 1).alias("p")  # the functions count from 1
    blocks = hashes.select(place).groupBy(F.bitmap_bucket_number("p").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    table = np.zeros(size // 8, dtype=np.uint8)
    for block, part in blocks.collect():  # size / 32768 rows at most
        at = (block - 1) * 4096
        table[at:at + 4096] |= np.frombuffer(bytes(part), dtype=np.uint8)[:size // 8 - at]
    return table


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(len(bits) * 8 - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 != 0


def _possible(chunk: Chunk, k: int, tables: Sequence[np.ndarray]) -> np.ndarray:
    """First words of the whole runs of k words both of whose parts of k - 1 words pass their table."""
    ok = chunk.whole(k)
    if len(ok):
        part = _passes(tables[k - 2], chunk.hashes(k - 1))
        ok &= part[:-1] & part[1:]
    return np.nonzero(ok)[0]


def _frequent(chunk: Chunk, k: int, tables: Sequence[np.ndarray]) -> np.ndarray:
    """First words of the possible runs of k words that pass their own table too."""
    at = _possible(chunk, k, tables)
    return at[_passes(tables[k - 1], chunk.hashes(k)[at])]


def hashed_counts(texts: DataFrame, k: int, tables: Sequence[np.ndarray]) -> DataFrame:
    """(gram, n): occurrences of each hash of a run of k words whose parts can be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def given() -> pa.RecordBatch:
            grams, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n)], ["gram", "n"])

        for chunk in _chunks(batches):
            held.append(chunk.hashes(k)[_possible(chunk, k, tables)])
            if sum(map(len, held)) > HELD:
                yield given()
        if held:
            yield given()

    return texts.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def possible_phrases(texts: DataFrame, longest: int, tables: Sequence[np.ndarray]) -> DataFrame:
    """(gram, lang, phrase): the distinct phrases of 2 to ``longest`` words that can be frequent.

    A task gives each phrase out once, as long as it can remember those it has given.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros((2, 1), dtype=np.uint64)  # two hashes of each phrase, by the first
        for chunk in _chunks(batches):
            fresh = [known]
            for k in range(2, longest + 1):
                at = _frequent(chunk, k, tables)
                own = np.stack([chunk.hashes(k, which)[at] for which in (0, 1)])
                place = np.minimum(np.searchsorted(known[0], own[0]), known.shape[1] - 1)
                at, _ = chunk.distinct(at[(known[:, place] != own).any(axis=0)], k)
                own = np.stack([chunk.hashes(k, which)[at] for which in (0, 1)])
                fresh.append(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[0].view(np.int64)), chunk.names(at), chunk.texts(at, k)], ["gram", "lang", "phrase"])
            if known.shape[1] < HELD:
                known = np.concatenate(fresh, axis=1)
                known = known[:, np.argsort(known[0], kind="stable")]

    return texts.mapInArrow(run, "gram long, lang string, phrase string").repartition("gram").distinct()


@dataclass
class DoubleArray:
    """A trie whose node at slot s has its child of symbol c at slot ``base[s] + c``, if ``check`` there is s.

    Slot 0 is the root. ``value`` is the number of the key that ends at a slot, or -1.
    """

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The slots that all states go to, -1 where there is no such child. States of -1 stay there."""
        to = self.base[states] + symbols
        inside = (states >= 0) & (symbols >= 0) & (to >= 0) & (to < len(self.check))
        to = np.where(inside, to, 0)
        return np.where(inside & (self.check[to] == states), to, -1)

    @classmethod
    def build(cls, symbols: np.ndarray, offsets: np.ndarray) -> DoubleArray:
        """Of distinct keys: key i is ``symbols[offsets[i]:offsets[i + 1]]``, none empty.

        Nodes are numbered level by level. Children are placed for all nodes of a number of children at
        once, those with most first: each node draws a base, and those whose places are free and drawn by
        no other keep it. The table grows where that takes too many rounds.
        """
        sizes = np.diff(offsets)
        alphabet = int(symbols.max()) + 1 if len(symbols) else 1
        node = np.zeros(len(sizes), dtype=np.int64)
        final = np.zeros(len(sizes), dtype=np.int64)
        parents, labels, nodes = [], [], 1
        for depth in range(int(sizes.max()) if len(sizes) else 0):
            on = np.nonzero(sizes > depth)[0]
            edges, own = np.unique(node[on] * alphabet + symbols[offsets[on] + depth], return_inverse=True)
            parents.append(edges // alphabet)
            labels.append(edges % alphabet)
            node[on] = nodes + own
            nodes += len(edges)
            done = on[sizes[on] == depth + 1]
            final[done] = node[done]
        parent = np.concatenate([np.zeros(0, np.int64), *parents])
        label = np.concatenate([np.zeros(0, np.int64), *labels])
        slot, base = _places(parent, label, nodes, alphabet)
        size = int(slot.max()) + 1
        made = cls(np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32))
        made.base[slot] = base
        made.check[slot[1:]] = slot[parent]
        made.value[slot[final]] = np.arange(len(sizes))
        return made


def _places(parent: np.ndarray, label: np.ndarray, nodes: int, alphabet: int) -> tuple[np.ndarray, np.ndarray]:
    """Slot and base of each node. Edge i leads from node ``parent[i]``, in ascending order, to node i + 1."""
    random = np.random.default_rng(13)
    slot, base = np.zeros(nodes, dtype=np.int64), np.zeros(nodes, dtype=np.int64)
    owners, first, count = np.unique(parent, return_index=True, return_counts=True)
    used = np.zeros(2 * nodes + alphabet + 1, dtype=bool)
    used[0] = True
    drawn = np.empty(len(used), dtype=np.int64)
    for number in np.unique(count)[::-1].tolist():
        left, rounds = np.nonzero(count == number)[0], 0
        while len(left):
            places = 1 + random.integers(0, len(used) - alphabet, len(left))[:, None] + _rows(label, first[left], number)
            drawn[places.reshape(-1)] = np.repeat(np.arange(len(left)), number)
            ok = ~used[places].any(axis=1) & (drawn[places] == np.arange(len(left))[:, None]).all(axis=1)
            used[places[ok]] = True
            slot[_rows(np.arange(1, nodes), first[left[ok]], number)] = places[ok]
            base[owners[left[ok]]] = places[ok, 0] - label[first[left[ok]]]
            left, rounds = left[~ok], rounds + 1
            if rounds % 50 == 0:  # too full for nodes of so many children
                used = np.concatenate([used, np.zeros(len(used) // 4 + alphabet, dtype=bool)])
                drawn = np.empty(len(used), dtype=np.int64)
    return slot, base


def _rows(values: np.ndarray, first: np.ndarray, number: int) -> np.ndarray:
    return values[first[:, None] + np.arange(number)]


class Tries:
    """Two tries: bytes of (language, word) to a word's number, and word numbers to a phrase's."""

    def __init__(self, words: DoubleArray, phrases: DoubleArray, langs: dict[str, int]) -> None:
        """``langs``: the slot that the bytes of a language lead to."""
        self.words, self.phrases, self.langs = words, phrases, langs

    @classmethod
    def build(cls, langs: list[str], phrases: list[str]) -> Tries:
        """Of distinct (language, phrase); a phrase's number is its place."""
        number: dict[tuple[str, str], int] = {}
        keys = [[number.setdefault((lang, word), len(number)) for word in phrase.split(" ")] for lang, phrase in zip(langs, phrases)]
        heads = {lang: lang.encode() + b"\n" for lang in set(langs)}  # no word has a line break in it
        spelled = [heads[lang] + word.encode() for lang, word in number]
        words = DoubleArray.build(np.frombuffer(b"".join(spelled), dtype=np.uint8).astype(np.int64), _offsets(spelled))
        starts = {}
        for lang, head in heads.items():
            at = np.zeros(1, dtype=np.int64)
            for c in head:
                at = words.step(at, np.array([c]))
            starts[lang] = int(at[0])
        flat = np.array([i for key in keys for i in key], dtype=np.int64)
        return cls(words, DoubleArray.build(flat, _offsets(keys)), starts)

    def word_numbers(self, chunk: Chunk) -> np.ndarray:
        """The number of each word, -1 for those of no phrase: all words' states go on byte by byte."""
        found = np.full(len(chunk), -1, dtype=np.int64)
        states = np.array([self.langs.get(x, -1) for x in chunk.langs], dtype=np.int64)[chunk.lang]
        on = np.nonzero(states >= 0)[0]
        states, place = states[on], chunk.starts[on]
        while len(on):
            here = chunk.data[place]
            over = place == chunk.ends[on]
            found[on[over]] = self.words.value[states[over]]
            states = self.words.step(states, np.where(over, -1, here.astype(np.int64)))
            stay = states >= 0
            on, states, place = on[stay], states[stay], place[stay] + 1
        return found

    def accepted(self, chunk: Chunk, longest: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each length k, the phrase that the k words from each word on are, or -1."""
        words = self.word_numbers(chunk)
        states = self.phrases.step(np.zeros(len(words), dtype=np.int64), words)
        for k in range(2, longest + 1):
            n = max(0, len(words) - k + 1)
            states = self.phrases.step(np.where(chunk.whole(k), states[:n], -1), words[k - 1:k - 1 + n])
            yield k, np.where(states >= 0, self.phrases.value[states], -1)


def _offsets(keys: Sequence) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([len(k) for k in keys], dtype=np.int64)]).astype(np.int64)


def _built(heads: DataFrame) -> Tries:
    """The tries of a bounded frame (id, lang, phrase), built in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        tries = Tries.build([r[1] for r in rows], [r[2] for r in rows])
        for trie in ("words", "phrases"):
            for field in ("base", "check", "value"):
                data = getattr(getattr(tries, trie), field).tobytes()
                for at in range(0, len(data), SLICE):
                    yield pa.RecordBatch.from_pydict({"name": [f"{trie} {field}"], "at": [at], "data": [data[at:at + SLICE]]})
        for lang, slot in tries.langs.items():
            yield pa.RecordBatch.from_pydict({"name": ["lang"], "at": [slot], "data": [lang.encode()]})

    parts: dict[str, list[bytes]] = {}
    langs = {}
    rows = heads.coalesce(1).mapInArrow(run, "name string, at long, data binary").collect()
    for row in sorted(rows, key=lambda r: (r["name"], r["at"])):
        if row["name"] == "lang":
            langs[bytes(row["data"]).decode()] = row["at"]
        else:
            parts.setdefault(row["name"], []).append(bytes(row["data"]))
    array = {name: np.frombuffer(b"".join(x), dtype=np.int32) for name, x in parts.items()}
    words, phrases = (DoubleArray(*[array[f"{t} {f}"] for f in ("base", "check", "value")]) for t in ("words", "phrases"))
    return Tries(words, phrases, langs)


def trie_counts(texts: DataFrame, tries: Tries, size: int, longest: int) -> DataFrame:
    """(id, a): occurrences of the ``size`` phrases of the tries. Each task adds up its own texts' accepting states."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for chunk in _chunks(batches):
            found = np.concatenate([ids[ids >= 0] for _, ids in tries.accepted(chunk, longest)])
            total += np.bincount(found, minlength=size)
        ids = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    return texts.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("a"))


def phrase_counts(texts: DataFrame, words: DataFrame, longest: int, least: int, most_phrases: int = MOST_PHRASES) -> DataFrame:
    """(lang, phrase, a): all phrases of 2 to ``longest`` words with ``least`` occurrences in (lang, text).

    A phrase can only be that frequent if its parts of one word less are. So level by level, the hashes
    of the runs whose parts passed are counted, and those that reach ``least`` pass: equal hashes only add
    up, so no frequent phrase is missed. The most frequent phrases, ``most_phrases`` at most, become two
    double-array tries that are sent to all tasks, which count them. What passed beyond that bound keeps
    the count of its hash, which is exact as every other phrase of that hash would have passed too; where
    several have, they go to the tries.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(chunk.hashes(1).view(np.int64))], ["gram"])

    frequent = words.where(F.col("a") >= least).select("lang", F.col("phrase").alias("text"))
    tables, hashes = [bit_table(frequent.mapInArrow(hashed, "gram long"))], None
    for k in range(2, longest + 1):
        level = keep(hashed_counts(texts, k, tables).where(F.col("n") >= least), "level")
        tables.append(bit_table(level))
        hashes = level if hashes is None else hashes.unionByName(level)
    # The least power of two of the counts from which on all phrases fit into the tries.
    power = F.floor(F.log2("n")).cast("int")
    room, floor = most_phrases, 64
    for row in sorted(hashes.groupBy(power.alias("power")).count().collect(), key=lambda r: -r.power):  # 64 rows at most
        room -= row["count"]
        if room < 0:
            break
        floor = row.power
    same = F.count("*").over(Window.partitionBy("gram"))
    # A task gives a phrase out once, so a few splits a task make fewer rows of the same phrases.
    splits = texts.rdd.getNumPartitions()
    few = texts.coalesce(max(2 * texts.sparkSession.sparkContext.defaultParallelism, -(-splits // SPLITS)))
    # Dealt by hash once, for the comparison of texts, the join and the count of phrases of one hash.
    named = keep(possible_phrases(few, longest, tables).join(hashes, "gram").withColumn("same", same), "possible")
    in_tries = (F.col("same") > 1) | (power >= floor) & (F.octet_length("phrase") <= PHRASE_BYTES)
    number = F.monotonically_increasing_id()  # of one partition: 0, 1, 2, ...
    heads = keep(named.where(in_tries).select("lang", "phrase").coalesce(1).withColumn("id", number), "heads")
    size = heads.count()
    found = named.where(~in_tries).select("lang", "phrase", F.col("n").alias("a"))
    if size:
        counted = trie_counts(texts, _built(heads.select("id", "lang", "phrase")), size, longest)
        found = found.unionByName(counted.join(heads, "id").select("lang", "phrase", "a").where(F.col("a") >= least))
    return found


def _part(phrase: Column, first: int, last: int) -> Column:
    """Words ``first`` to ``last`` of a phrase, from 1 on."""
    return F.array_join(F.slice(F.split(phrase, " "), first, last - first + 1), " ")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = 3, least: int = 10, top: int = 2000,
    inside_percent: int = 50, most_phrases: int = MOST_PHRASES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases whose words come together most, for each language.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and pieces into words at
    blanks. Phrases are 2 to ``longest`` words of a piece with ``least`` occurrences ``a`` in the language,
    overlaps included. Cut in two, a phrase scores 1,000,000 a a / (l r), whole part, where its parts
    occur l and r times; its worst cut counts, of equal ones the first. Phrases that lie inside a longer
    one with at least ``inside_percent`` of their occurrences are dropped, then each language's ``top`` by
    score, frequency and text are given. ``n`` is the number of the language's words.

    A null language is ``und``; null and empty texts have no words; repeated rows count each time; an
    empty table gives an empty result.
    """
    texts = _texts(docs, lang, text)
    words = keep(word_counts(texts), "words")
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    phrases = keep(phrase_counts(texts, words, longest, least, most_phrases), "phrases")
    counts = phrases.unionByName(words.where(F.col("a") >= least))
    length = F.size(F.split("phrase", " "))
    cuts = phrases.withColumn("size", length).withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "cut", _part(F.col("phrase"), F.lit(1), F.col("cut")).alias("front"),
                       _part(F.col("phrase"), F.col("cut") + 1, F.col("size")).alias("back"))
    for part, name in (("front", "l"), ("back", "r")):
        known = counts.select(F.col("lang").alias("k_lang"), F.col("phrase").alias("k"), F.col("a").alias(name))
        cuts = cuts.join(known, (F.col("lang") == F.col("k_lang")) & (F.col(part) == F.col("k"))).drop("k_lang", "k")
    worst = F.min(F.struct(F.expr(SCORE).alias("score"), "cut", "l", "r")).alias("w")
    scored = cuts.groupBy("lang", "phrase", "a").agg(worst).select("lang", "phrase", "a", "w.l", "w.r", "w.score")
    longer = phrases.withColumn("size", length).where("size > 2").withColumn(
        "inner", F.explode(F.sequence(F.lit(2), F.col("size") - 1))).withColumn(
        "first", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("inner") + 1)))
    inside = longer.select(F.col("lang").alias("i_lang"), _part(F.col("phrase"), F.col("first"), F.col("first") + F.col("inner") - 1).alias("i"),
                           "a").groupBy("i_lang", "i").agg(F.max("a").alias("most"))
    left = scored.join(inside, (F.col("lang") == F.col("i_lang")) & (F.col("phrase") == F.col("i")), "left")
    left = left.where(F.coalesce(100 * F.col("most") < inside_percent * F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(totals.withColumnRenamed("lang", "t_lang"), F.col("lang") == F.col("t_lang")).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
