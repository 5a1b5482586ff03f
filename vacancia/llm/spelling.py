"""Spelling variants: words one edit apart, found in k-d trees over letter counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import keep, pick, small_side

LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST_CHARS, LEAST_COUNT = 5, 3
#: Letters that are counted apart: a to z each, all others folded into the rest. Folding only brings
#: vectors nearer to each other, so it costs some checks of letter order and loses nothing.
LATIN, AXES = 26, 64
#: Letters of the words that one work unit indexes, about, and vectors of a leaf of its own tree.
UNIT_CHARS, LEAF = 1 << 18, 64
#: Words, about so many of the smallest hashes, by which the upper levels of the trees are laid out. They
#: decide where words are looked for together, never what is found.
SAMPLE_WORDS = 1 << 16
#: Letters of word pairs that are compared at once.
CHUNK_CHARS = 1 << 22
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(
    docs: DataFrame, key: str = "doc_id", text: str = "text", letters: str = LETTERS, least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT, change: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """(word, n): the maximal runs of ``letters`` with A-Z lower-cased, and how often each occurs.

    ``change`` makes another word of a key and a run, none longer. Words of fewer than ``least_chars``
    characters or ``least_count`` occurrences are left out. Null texts have no words.
    """
    runs = F.regexp_extract_all("text", F.lit(f"(?:{letters}){{{least_chars},}}+"), F.lit(0))
    each = pick(docs, key=key, text=text).select("key", F.explode(runs).alias("run"))
    word = F.translate("run", _UPPER, _LOWER)
    each = each.select("key", word.alias("word"))
    if change is not None:
        each = each.select(change(F.col("key"), F.col("word")).alias("word")).where(F.length("word") >= least_chars)
    return each.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def codes_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words' code points one after another, and how many each has."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32), sizes


def letter_counts(words: list[str]) -> np.ndarray:
    """How often each axis's letters occur in each word: (words, AXES)."""
    codes, sizes = codes_of(words)
    plain = codes - np.uint32(ord("a"))
    axis = np.where(plain < LATIN, plain, LATIN + codes % np.uint32(AXES - LATIN)).astype(np.int64)
    rows = np.repeat(np.arange(len(words)), sizes)
    return np.bincount(rows * AXES + axis, minlength=len(words) * AXES).reshape(-1, AXES)


@dataclass
class Tree:
    """Splits of the space of letter counts: at node i, counts on ``axis[i]`` up to ``value[i]`` go left.

    Children below zero are leaves: ~child is the leaf's number.
    """

    axis: list[int] = field(default_factory=list)
    value: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    leaves: int = 0

    def grow(self, points: np.ndarray, rows: np.ndarray, most: float, members: list[np.ndarray] | None = None) -> int:
        """Split until a leaf has ``most`` points at most, or only equal ones."""
        spread = points[rows].var(axis=0) if len(rows) else np.zeros(points.shape[1])
        axis = int(spread.argmax())
        if len(rows) <= most or spread[axis] == 0:
            if members is not None:
                members.append(rows)
            self.leaves += 1
            return ~(self.leaves - 1)
        along = points[rows, axis]
        cut = min(int(np.median(along)), int(along.max()) - 1)
        node = len(self.axis)
        self.axis.append(axis)
        self.value.append(cut)
        self.left.append(0)
        self.right.append(0)
        self.left[node] = self.grow(points, rows[along <= cut], most, members)
        self.right[node] = self.grow(points, rows[along > cut], most, members)
        return node

    def reached(self, points: np.ndarray, more: int, fewer: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each leaf with the points from which it can be reached by ``more`` letters added and ``fewer`` removed.

        The boxes of the splits above prune: a box that starts beyond a point's count on an axis costs as
        many added letters, one that ends before it as many removed ones, over all axes.
        """
        n, axes = points.shape
        todo = [(0 if self.axis else ~0, np.arange(n), np.full(n, more), np.full(n, fewer), np.zeros(axes, np.int64),
                 np.full(axes, np.iinfo(np.int32).max))]
        while todo:
            node, rows, up, down, low, high = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                yield ~node, rows
                continue
            axis, cut = self.axis[node], self.value[node]
            own = points[rows, axis]
            removed = down - np.maximum(own - cut, 0) + np.maximum(own - high[axis], 0)
            added = up - np.maximum(cut + 1 - own, 0) + np.maximum(low[axis] - own, 0)
            for child, left_up, left_down, bounds in (
                (self.left[node], up, removed, (low, _with(high, axis, cut))), (self.right[node], added, down, (_with(low, axis, cut + 1), high)),
            ):
                ok = (left_up >= 0) & (left_down >= 0)
                todo.append((child, rows[ok], left_up[ok], left_down[ok], *bounds))


def _with(bounds: np.ndarray, axis: int, value: int) -> np.ndarray:
    bounds = bounds.copy()
    bounds[axis] = value
    return bounds


class Unit:
    """Words of one length, in a k-d tree of their own with the tight box of each leaf."""

    def __init__(self, words: list[str], counts: list[int]) -> None:
        self.words, self.counts, self.length = words, counts, len(words[0])
        self.points = letter_counts(words)
        self.codes = codes_of(words)[0].reshape(len(words), self.length)
        self.members: list[np.ndarray] = []
        self.tree = Tree()
        self.tree.grow(self.points, np.arange(len(words)), LEAF, self.members)
        self.low = np.stack([self.points[m].min(axis=0) for m in self.members])
        self.high = np.stack([self.points[m].max(axis=0) for m in self.members])

    def near(self, words: list[str], more: int, fewer: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of ``words``, own row) exactly one edit apart: one letter replaced, or one added."""
        points = letter_counts(words)
        found = []
        for leaf, rows in self.tree.reached(points, more, fewer):
            near = points[rows]
            ok = (np.maximum(self.low[leaf] - near, 0).sum(axis=1) <= more) & (np.maximum(near - self.high[leaf], 0).sum(axis=1) <= fewer)
            rows, near = rows[ok], near[ok].astype(np.float64)
            if not len(rows):
                continue
            mine = self.members[leaf]
            theirs = self.points[mine].astype(np.float64)
            # Differences of one letter more and one fewer have squares that add up to as many.
            apart = (near * near).sum(axis=1)[:, None] + (theirs * theirs).sum(axis=1)[None] - 2 * (near @ theirs.T)
            i, j = np.nonzero(apart <= more + fewer)
            found.append((rows[i], mine[j]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        i, j = (np.concatenate(x) for x in zip(*found))
        codes = codes_of(words)[0].reshape(len(words), -1)
        step = max(1, CHUNK_CHARS // self.length)
        right = [self._one_edit(codes, i[at:at + step], j[at:at + step]) for at in range(0, len(i), step)]
        ok = np.concatenate(right) if right else np.zeros(0, bool)
        return i[ok], j[ok]

    def _one_edit(self, codes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether letters agree in their order but for one place."""
        ours, theirs = codes[i], self.codes[j]
        if ours.shape[1] == self.length:
            return (ours != theirs).sum(axis=1) == 1
        same_start = np.logical_and.accumulate(ours == theirs[:, :-1], axis=1).sum(axis=1)
        same_end = np.logical_and.accumulate((ours == theirs[:, 1:])[:, ::-1], axis=1).sum(axis=1)
        return same_start + same_end >= ours.shape[1]


class Layout:
    """The upper levels of a tree for each word length. A leaf's number holds its length above 32 bits."""

    def __init__(self, sample: list[str], share: float) -> None:
        """``share``: the part of all words that the sample is."""
        self.trees: dict[int, Tree] = {}
        by_length: dict[int, list[str]] = {}
        for word in sample:
            by_length.setdefault(len(word), []).append(word)
        for length, words in by_length.items():
            tree = self.trees[length] = Tree()
            points = letter_counts(words)
            tree.grow(points, np.arange(len(words)), max(1.0, UNIT_CHARS / length / 2 * share))

    def reached(self, words: list[str], length: int, more: int, fewer: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves of words of ``length`` letters, with the rows of ``words`` that have to be looked for there."""
        tree = self.trees.get(length) or Tree()
        for leaf, rows in tree.reached(letter_counts(words), more, fewer):
            yield length << 32 | leaf, rows


#: What a routed word is in its work unit: indexed; looked for among its length; among one letter more.
INDEXED, SAME, LONGER = 0, 1, 2


def _routed(words: DataFrame, layout: Layout, roles: tuple[int, ...]) -> DataFrame:
    """(leaf, role, word, n): each word to the leaf it lies in, and to all where a word one edit apart can lie."""
    # Letters more and fewer that a near word may have, and how much longer it is.
    reach = {INDEXED: (0, 0, 0), SAME: (1, 1, 0), LONGER: (1, 0, 1)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = np.array(batch.column(0).to_pylist(), dtype=object)
            sizes = np.array([len(w) for w in texts], dtype=np.int64)
            for length in np.unique(sizes).tolist():
                at = np.nonzero(sizes == length)[0]
                own = texts[at].tolist()
                for role in roles:
                    more, fewer, longer = reach[role]
                    for leaf, rows in layout.reached(own, length + longer, more, fewer):
                        part = batch.take(pa.array(at[rows]))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rows), leaf)), pa.array(np.full(len(rows), role, dtype=np.int32)), *part.columns],
                            ["leaf", "role", "word", "n"],
                        )

    return words.select("word", "n").mapInArrow(run, "leaf long, role int, word string, n long")


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs one edit apart in each work unit of sorted rows (leaf, tile, role, word, n).

    A unit's indexed words come first and are held; those that are looked for pass by in batches.
    """
    own, words, counts, unit = None, [], [], None
    for batch in batches:
        leaf, tile, role = (batch.column(c).to_numpy() for c in range(3))
        cuts = np.nonzero((np.diff(leaf) != 0) | (np.diff(tile) != 0) | (np.diff(role) != 0))[0] + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(leaf)]):
            if lo == hi:
                continue
            if own != (leaf[lo], tile[lo]):
                own, words, counts, unit = (leaf[lo], tile[lo]), [], [], None
            texts, ns = (batch.column(c).slice(lo, hi - lo) for c in (3, 4))
            if role[lo] == INDEXED:
                words += texts.to_pylist()
                counts += ns.to_pylist()
                continue
            if not words:
                continue
            unit = unit or Unit(words, counts)
            asked, ns = texts.to_pylist(), ns.to_numpy()
            i, j = unit.near(asked, 1, int(role[lo] == SAME))
            near, known = pa.array(words).take(pa.array(j)), np.array(counts, dtype=np.int64)[j]
            ours = texts.take(pa.array(i))
            yield pa.RecordBatch.from_arrays([ours, near, pa.array(known)], ["word", "near", "near_n"])
            if role[lo] == LONGER:  # the longer word isn't looked for among shorter ones
                yield pa.RecordBatch.from_arrays([near, ours, pa.array(ns[i])], ["word", "near", "near_n"])


def near_words(words: DataFrame, rows: int) -> DataFrame:
    """(word, near, near_n): all pairs of the distinct ``words`` (word, n) that are one edit apart, both ways round.

    The letters of a word give a vector of counts; one edit changes it by at most two. For each length,
    the upper levels of a k-d tree over the vectors cut the words into work units, and a word is sent
    to the units of its own length and the next whose boxes its neighbours can lie in. A unit goes on
    with a tree of its own, whose boxes prune again; what is left is compared letter by letter. Units
    that turn out too large, as of equal vectors, are dealt into tiles, each of which all that is looked
    for there visits. ``rows`` is the number of words.
    """
    part = min(1.0, SAMPLE_WORDS / max(rows, 1))
    small = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < part * (1 << 20)
    sample = sorted(r[0] for r in words.where(small).select("word").collect())
    layout = Layout(sample, len(sample) / max(rows, 1))
    homes = _routed(words, layout, (INDEXED,)).groupBy("leaf").agg(F.sum(F.length("word")).alias("chars"))
    tiles = keep(homes.select("leaf", F.ceil(F.col("chars") / UNIT_CHARS).cast("int").alias("tiles")).where("tiles > 1"), "tiles", rows)
    number = tiles.count()
    sent = _routed(words, layout, (INDEXED, SAME, LONGER))
    if number:
        tiles = small_side(tiles.withColumnRenamed("leaf", "l"), number)
        all_tiles = F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1)
        one = F.array(F.pmod(F.xxhash64("word"), F.coalesce("tiles", F.lit(1))).cast("int"))
        sent = sent.join(tiles, F.col("leaf") == F.col("l"), "left").withColumn(
            "tile", F.explode(F.when(F.col("role") == INDEXED, one).otherwise(all_tiles)))
    else:
        sent = sent.withColumn("tile", F.lit(0))
    order = ["leaf", "tile", "role"]
    dealt = sent.select(*order, "word", "n").repartition("leaf", "tile").sortWithinPartitions(*order)
    return dealt.mapInArrow(_search, "word string, near string, near_n long")


def _roots(forms: DataFrame, rows: int) -> DataFrame:
    """(word, root) of the words of ``forms`` (word, form): the last form that is reached.

    Every round follows as many forms at once as all rounds before. A form is at least twice as
    frequent as its word, so there are no cycles and few rounds.
    """
    at = keep(forms.select("word", F.col("form").alias("root")), "roots", rows)
    number = at.count()
    while True:
        onward = small_side(at.select(F.col("word").alias("w"), F.col("root").alias("next")), number)
        step = keep(at.join(onward, F.col("root") == F.col("w"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots", rows)
        at = step.select("word", "root")
        if not step.where("moved").head(1):
            return at


def spelling_forms(words: DataFrame, ratio: float = 2.0) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of the distinct ``words`` (word, n).

    Words are near if they differ by exactly one inserted, deleted or replaced character. A word's
    ``form`` is its most frequent near word (of equally frequent ones the first by code point), if that
    occurs at least ``ratio`` (above 1) times as often; ``root`` is the last word that is reached over
    forms, the word itself without any. No words: no rows. A null word is no word.
    """
    if ratio <= 1:
        raise ValueError("a form has to be more frequent than its word")
    words = keep(words.select("word", "n").where("word != ''"), "words")
    rows = words.count()
    near = near_words(words, rows).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = words.join(near.withColumnRenamed("word", "w"), F.col("word") == F.col("w"), "left")
    enough = -F.col("best.less") >= ratio * F.col("n")
    known = keep(known.select(
        "word", F.when(enough, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    ), "forms")
    roots = _roots(known.where("form is not null"), rows).withColumnRenamed("word", "w")
    return known.join(roots, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
