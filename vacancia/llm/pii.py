"""Personal data: validated patterns, and identifiers found by bootstrapping from their contexts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import keep, packed, pick
from vacancia.llm.spans import apart, clean, matches, parts

# Each pattern starts only where a run does (or where the match before ended), and gives nothing back,
# so a text takes time in proportion to its length whatever it holds.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A word with a digit in it: what may be an identifier.
NUMBERED = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
KINDS = ("email", "ip", "card", "phone", "id")
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

#: Score from which on a pattern or an instance counts, and confident instances that a pattern needs.
CONFIDENT, LEAST_INSTANCES = 0.75, 3
#: Characters and digits that an unseen identifier has at least.
LEAST_CHARS, LEAST_DIGITS = 5, 4
#: Characters before and after an instance among which the words of its patterns are looked for; its
#: left context goes back over three words with digits at most.
CONTEXT_CHARS = 120


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether there are 16 to 19 digits, the last of which checks the others."""
    n = F.length(_digits(value))
    figures = F.transform(F.regexp_extract_all(F.reverse(value), F.lit("[0-9]"), 0), lambda c: c.cast("int"))
    counted = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0)))
    check = F.aggregate(counted, F.lit(0), lambda a, d: a + d) % 10 == 0
    return F.when((n >= 16) & (n <= 19), check).otherwise(False)


#: Pattern, a string that every match has, and what a match has to meet.
BASE = {
    "email": (EMAIL, "@", lambda v: F.lit(True)),
    "ip": (IP, ".", lambda v: v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
    "card": (CARD, None, _luhn),
    "phone": (PHONE, "+", lambda v: F.length(_digits(v)).between(8, 15)),
}


def _patterns(left: Column, right: Column) -> Column:
    """The lexical patterns around a span: three words before it; two before and one after; a label."""
    word = F.lit(r"[^\x20\x09-\x0D]+")
    before, after = (F.regexp_extract_all(F.lower(side), word, 0) for side in (left, right))
    last = F.coalesce(F.get(before, F.size(before) - 1), F.lit(""))
    two = F.array_join(F.slice(before, F.size(before) - 1, 2), " ")
    found = F.array(
        F.when(F.size(before) >= 3, F.concat(F.array_join(F.slice(before, F.size(before) - 2, 3), " "), F.lit(" _"))),
        F.when((F.size(before) >= 2) & (F.size(after) >= 1), F.concat(two, F.lit(" _ "), F.get(after, 0))),
        F.when(last.rlike("[:#]$"), F.concat(last, F.lit(" _"))),
    )
    return F.filter(found, lambda p: p.isNotNull())


def _span(kind: str, start: Column, value: Column, left: Column, right: Column) -> Column:
    return F.struct(
        F.lit(KINDS.index(kind)).alias("rank"), start.alias("start"), (start + F.length(value)).alias("end"),
        F.lit(kind).alias("kind"), F.xxhash64(value).alias("h"), F.xxhash64(F.lit(1), value).alias("g"),
        left.alias("left"), right.alias("right"),
    )


def instances(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(row, key, base, unknown): validated spans, and other words that could be identifiers.

    Each has a mark of its value and its patterns, not the text itself.
    """
    df = pick(docs, key=key, text=text).withColumn("text", clean(F.col("text")))
    # A text without digits has nothing but e-mail addresses.
    numbered = F.col("text").rlike("[0-9]")

    def cut(kind, pattern, needs):
        found = parts(F.col("text"), pattern, needs)
        return found if kind == "email" else F.when(F.col("numbered"), found).otherwise(F.array("text"))

    pieces = {kind: (pattern, needs) for kind, (pattern, needs, _) in BASE.items()} | {"unknown": (NUMBERED, None)}
    df = df.withColumn("numbered", numbered).select("key", "text", *[cut(k, *p).alias(k) for k, p in pieces.items()])
    df = df.select("key", *[matches(F.col(k), CONTEXT_CHARS).alias(k) for k in pieces])

    def valid(kind, ok):
        return F.transform(F.filter(kind, lambda s: ok(s["value"])),
                           lambda s: _span(kind, s["start"], s["value"], s["left"], s["right"]))

    def trimmed(s):
        """A word without the symbols around it, which belong to its context."""
        bare = F.regexp_replace(s["value"], "^[^A-Za-z0-9+]++", "")
        value = F.regexp_replace(bare, "(?<![^A-Za-z0-9])[^A-Za-z0-9]++$", "")
        cut = F.length(s["value"]) - F.length(bare)
        left = F.concat(s["left"], F.left(s["value"], cut.cast("int")))
        right = F.concat(F.substr(bare, F.length(value) + 1), s["right"])
        return _span("id", s["start"] + cut, value, left, right)

    long_enough = F.filter(
        F.transform(F.filter("unknown", lambda s: F.length(_digits(s["value"])) >= LEAST_DIGITS), trimmed),
        lambda s: s["end"] - s["start"] >= LEAST_CHARS,
    )
    df = df.select("key", F.array_sort(F.concat(*[valid(k, ok) for k, (_, _, ok) in BASE.items()])).alias("base"), long_enough.alias("unknown"))
    df = df.withColumn("unknown", F.when(F.size("unknown") > 0, apart(F.col("unknown"), F.col("base"))).otherwise(F.col("unknown")))

    def with_patterns(spans):
        return F.transform(spans, lambda s: s.withField("patterns", _patterns(s["left"], s["right"])).dropFields("left", "right"))

    return df.select("key", *[with_patterns(c).alias(c) for c in ("base", "unknown")]).withColumn("row", F.monotonically_increasing_id())


def learn(found: DataFrame, confident: float = CONFIDENT, least_instances: int = LEAST_INSTANCES,
          rows: int | None = None) -> DataFrame:
    """(pattern, score): patterns that become confident in however many rounds of scoring the graph ``found``.

    ``found`` has a row (pattern, h, g, seed) per occurrence; an instance is a distinct value. Seeds
    score 1. A pattern scores the sum of its instances' scores over their number plus one, if at least
    ``least_instances`` of them are confident; an instance that is no seed scores as its best confident
    pattern, so what a pattern discovers supports further patterns. Patterns with fewer instances can't
    become confident and leave the graph first. No score ever falls, so rounds end when none has risen, or
    when no pattern is new and no other could become confident if all that was found scored 1. Only sums by pattern and maxima by instance are
    computed, both pre-aggregated; no pattern's or instance's neighbours are gathered. ``rows`` is about
    the number of edges, if it is known.
    """
    edges = found.groupBy("pattern", "h", "g").agg(F.max("seed").alias("seed"))
    edges = keep(edges, "edges", rows)
    n = edges.count()
    # Written first, so that the join has nothing but shuffles below, which can be split by pattern.
    wide = keep(edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= least_instances), "wide", n)
    edges = keep(edges.join(wide.select("pattern"), "pattern"), "edges", n)
    scores = edges.groupBy("h", "g").agg(F.max("seed").alias("seed")).withColumn("score", F.col("seed").cast("double"))
    before = None
    while True:
        patterns = edges.join(scores.select("h", "g", "score"), ["h", "g"]).groupBy("pattern").agg(
            F.sum("score").alias("sum"), F.count("*").alias("n"), F.count_if(F.col("score") >= confident).alias("sure")
        ).where(F.col("sure") >= least_instances)
        patterns = patterns.select("pattern", *[F.round(F.col(c) / (F.col("n") + 1), 9).alias(a) for c, a in (("sum", "score"), ("sure", "most"))])
        patterns = keep(patterns.where(F.col("most") >= confident), "patterns", n)
        # Exact decimals, so that equal scores have equal sums in any order.
        certain = F.col("score") >= confident
        now = patterns.agg(F.count_if(certain), F.count("*"), F.sum(F.col("score").cast("decimal(20,9)"))).first()
        patterns = patterns.where(certain).select("pattern", "score")
        if now == before or before and now[0] == before[0] == now[1]:
            break
        before = now
        best = edges.join(patterns, "pattern").groupBy("h", "g").agg(F.max("score").alias("best"))
        scores = scores.join(best, ["h", "g"], "left").select(
            "h", "g", "seed", F.when(F.col("seed") == 1, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score")
        )
        scores = keep(scores, "scores", n)
    return patterns


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", confident: float = CONFIDENT,
                  least_instances: int = LEAST_INSTANCES) -> DataFrame:
    """(key, base, spans) for every document; a span has rank, start, end, kind.

    ``base`` are validated e-mail addresses, IP addresses, card and phone numbers, by kind, then start.
    They seed the bootstrapping of ``learn``; ``spans`` adds, as kind ``id``, other words with digits in
    a context whose pattern became confident. A null or empty text has no spans; repeated rows come
    repeated, and repeated values are one instance; an empty table gives an empty result.
    """
    rows = keep(instances(docs, key, text), "instances")
    seen = rows.select("row", F.explode(F.concat("base", "unknown")).alias("s")).select("row", "s.*")
    each = seen.select("row", "start", "end", "kind", "h", "g", F.explode("patterns").alias("pattern"))
    seed = F.when(F.col("kind") == "id", 0).otherwise(1)
    patterns = learn(each.select("pattern", "h", "g", seed.alias("seed")), confident, least_instances, rows.count())
    new = each.where("kind = 'id'").join(patterns.select("pattern"), "pattern").groupBy("row").agg(F.array_sort(F.collect_set(
        F.struct(F.lit(KINDS.index("id")).alias("rank"), "start", "end", "kind"))).alias("new"))
    slim = F.transform("base", lambda s: F.struct(s["rank"], s["start"], s["end"], s["kind"]))
    slim = slim.cast("array<struct<rank:int,start:bigint,end:bigint,kind:string>>")
    found = rows.select("row", "key", slim.alias("base")).join(new, "row", "left").select(
        F.col("key").alias(key), "base",
        F.when(F.col("new").isNull(), F.col("base")).otherwise(F.concat("base", "new")).alias("spans"),
    )
    return packed(found, rows.count())
