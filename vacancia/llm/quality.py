"""Quality rules as a short-circuit cascade whose order is measured on a sample."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from copy import copy
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import chunks, hidden, pick, shown

#: Documents whose texts the driver reads to measure the rules, and the longest text among them.
SAMPLE_ROWS = 400
SAMPLE_CHARS = 100_000
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_NOT_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())


#: Work of a word or line that Python touches, in characters that a built-in scan passes over.
ITEM_WORK = 40


class Document:
    """A text and what the rules read of it, each computed when first asked for.

    ``work`` adds up what that took, counted in characters read and items handled, so that it is the
    same on every machine.
    """

    def __init__(self, text: str | None) -> None:
        self.text = text or ""
        self.work = 1

    def _read(self, times: int = 1, items: int = 0) -> None:
        self.work += times * len(self.text) + ITEM_WORK * items

    @cached_property
    def data(self) -> bytes:
        self._read()
        return self.text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        found = self.data.split()  # bytes split at space and \x09-\x0D alone
        self._read(1, len(found))
        return found

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        self._read(len(_SPACES))
        return len(self.text) - sum(map(self.text.count, _SPACES))

    @cached_property
    def n_symbols(self) -> int:
        self._read(len(SYMBOLS))
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        found = self.text.split("\n")
        self._read(2, len(found))
        return [line for line in found if line.strip(_SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        self._read(1, len(self.lines))
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        words = self.words
        self._read(1, 4 * len(words))
        windows = list(zip(words, words[1:], words[2:]))
        times = Counter(windows)
        if len(times) == len(windows):
            return 0
        covered = reach = 0
        for i, window in enumerate(windows):
            if times[window] > 1:
                covered += i + 3 - max(i, reach)
                reach = i + 3
        return covered

    @cached_property
    def n_letter_bytes(self) -> int:
        self._read()
        return len(self.data.translate(None, _NOT_LETTERS))


@dataclass(frozen=True)
class Rule:
    """A reason to reject a document."""

    name: str
    rejects: Callable[[Document], bool]


#: What every document has to meet.
BASE_RULES = (
    Rule("few_words", lambda d: d.n_words < 50),
    Rule("repeated_windows", lambda d: 100 * d.n_repeat_words > 50 * d.n_words),
)
#: Further rules; each leaves running prose of any language alone.
METHOD_RULES = (
    Rule("symbols", lambda d: 100 * d.n_symbols > 20 * d.n_words),
    Rule("repeated_lines", lambda d: 100 * d.n_dup_lines > 50 * len(d.lines)),
    Rule("word_length", lambda d: not 2 * d.n_words <= d.word_chars <= 15 * d.n_words),
    Rule("few_letters", lambda d: 100 * d.n_letter_bytes < 50 * d.word_chars),
)
RULES = BASE_RULES + METHOD_RULES
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Measured:
    """A rule's share of rejections and work for a document that the rules before it have left."""

    rule: Rule
    rejected: float
    work: float


def order_rules(texts: Sequence[str | None], rules: Sequence[Rule] = RULES) -> list[Measured]:
    """Rules in the order of rejections per work, each measured on what the ones before it leave.

    A rule's work is what it adds: a feature that an earlier rule has read is there already. Of equal
    rules the one declared first goes first. Without texts, or when nothing is left of them, the
    declared order stands.
    """
    left, rest, order = [Document(t) for t in texts], list(rules), []
    while rest:
        tried = []
        for rule in rest:
            fresh = [copy(d) for d in left]
            verdicts = [rule.rejects(d) for d in fresh]
            work = sum(d.work for d in fresh) - sum(d.work for d in left) + len(left)
            kept = [d for d, no in zip(fresh, verdicts) if not no]
            tried.append((Measured(rule, sum(verdicts) / max(1, len(left)), work / max(1, len(left))), kept))
        # Among rules that reject nothing here, the cheaper goes first.
        best = max(tried, key=lambda x: (x[0].rejected / max(x[0].work, 1), -x[0].work))
        order.append(best[0])
        left = best[1]
        rest.remove(best[0].rule)
    return order


def sample_texts(docs: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> list[str | None]:
    """At most ``rows`` texts of at most ``SAMPLE_CHARS`` characters, for measuring alone."""
    some = pick(docs, text=text).sample(0.1, seed=8)
    return [r[0] for r in some.where(F.length("text") <= SAMPLE_CHARS).limit(rows).collect()]


def rejected(doc: Document, order: Sequence[Rule]) -> bool:
    """Whether any rule rejects; the rules after the first that does aren't tried."""
    return any(rule.rejects(doc) for rule in order)


def first_rejection(doc: Document, order: Sequence[Rule], rules: Sequence[Rule]) -> str | None:
    """The name of the first of the declared ``rules`` that rejects, in whatever order they are tried.

    Once a rule rejects, only those declared before it are left to be tried.
    """
    if not rejected(doc, order):
        return None
    return next(rule.name for rule in rules if rule.rejects(doc))


def judge(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES,
    order: Sequence[Rule] | None = None, features: Sequence[str] = (),
) -> DataFrame:
    """One row per document: its key, ``rejected_by`` (null: kept) and the ``features`` asked for.

    The cascade stops at a document's first rejection. Its order follows ``order_rules`` unless given;
    it decides how much is read, and nothing of the result: ``rejected_by`` names the first of the
    declared ``rules`` that rejects. Features are completed after the verdict. A null or empty text has no words; repeated rows are judged alike; an empty table gives
    an empty result.
    """
    if order is None:
        order = [m.rule for m in order_rules(sample_texts(docs, text), rules)]
    source = pick(docs, key=key, text=text)
    kinds = ", ".join([f"key {source.schema['key'].dataType.simpleString()}", "rejected_by string",
                       *[f"{f} long" for f in features]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = [Document(t) for t in batch.column(1).to_pylist()]
            reasons = [first_rejection(d, order, rules) for d in found]
            columns = [pa.array([getattr(d, f) for d in found], pa.int64()) for f in features]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(reasons, pa.string()), *columns], ["key", "rejected_by", *features]
            )

    return source.mapInArrow(run, kinds).withColumnRenamed("key", key)


def keep_good(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents that no rule rejects, with all their columns. No row leaves its partition."""
    names = docs.columns
    order = [m.rule for m in order_rules(sample_texts(docs, text), rules)]

    @F.pandas_udf("boolean")
    def good(texts):
        return texts.map(lambda t: not rejected(Document(t), order)).astype(bool)

    df = hidden(docs)
    return shown(df.where(good(df[f"in_{names.index(text)}"])), names)
