"""Cross-entropy difference of documents under a target and a background n-gram model of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import chunks, keep, pick

#: Symbols of the vocabulary and tokens of an n-gram. Every byte of UTF-8 is a symbol of its own (A-Z
#: folded), and the one that no such text has marks the beginning; an n-gram's number is its bytes.
SYMBOLS, ORDER = 256, 4
BEGIN = 0xFF
#: Weight of the next shorter n-gram's estimate, in occurrences of the context.
PRIOR = 8.0
#: Bytes of the texts that get their n-grams' losses together.
CHUNK_BYTES = 1 << 22
#: Chunks of a task that scores them, on average.
TASK_CHUNKS = 2
#: What a document is part of: the background, or a half of the target.
BACKGROUND, EVEN, ODD = range(3)
#: The halves of the target in which n-grams are counted, and the models that come of the counts.
COUNTED = ("even", "odd", "background")
MODELS = ("target", *COUNTED)
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[ord("A"):ord("Z") + 1] += 32


def _packed(docs: DataFrame) -> DataFrame:
    """(key, n_tokens, packed): the bytes of each (key, text), compressed, as they are shuffled twice."""
    kind = docs.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 1)
        for batch in chunks(batches):
            texts = [x or b"" for x in batch.column(1).cast(pa.large_binary()).to_pylist()]
            sizes, blobs = pa.array([len(x) for x in texts], pa.int64()), [codec.compress(x, asbytes=True) for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(blobs, pa.binary())], ["key", "n_tokens", "packed"])

    return docs.select("key", "text").mapInArrow(run, f"key {kind}, n_tokens long, packed binary")


def _bytes(sizes: pa.Array, packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes one after another (A-Z folded), and where each begins and the last ends."""
    codec = pa.Codec("zstd", 1)
    sizes = sizes.to_numpy(zero_copy_only=False)
    texts = [codec.decompress(x.as_buffer(), int(n), asbytes=True) for n, x in zip(sizes, packed) if n]
    return _FOLDED[np.frombuffer(b"".join(texts), dtype=np.uint8)], np.concatenate([[0], np.cumsum(sizes)])


def _grams(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """For each byte, the number of the n-gram that ends there; a text is preceded by begin marks."""
    grams = data.astype(np.uint32 if order <= 4 else np.uint64)
    starts = offsets[:-1][np.diff(offsets) > 0]
    ends = offsets[1:][np.diff(offsets) > 0]
    for back in range(1, order):
        earlier = np.full(len(data), BEGIN, dtype=grams.dtype)
        earlier[back:] = data[:-back]
        for i in range(back):
            earlier[starts[starts + i < ends] + i] = BEGIN
        grams |= earlier << grams.dtype.type(8 * back)
    return grams


def prepared(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(chunk, key, part, mark, n_tokens, packed) of all documents, written; labelled ones are the target.

    A chunk is some documents of one partition, of about ``CHUNK_BYTES``. Labels (key) grow with the
    documents, so the join deals both by key at every size. Which half of the target a document is in
    follows from its text, so copies are in the same one.
    """
    wanted = pick(labels, label=key).where("label is not null").distinct().withColumn("is_target", F.lit(True))
    own = _packed(pick(docs, key=key, text=text))
    joined = own.join(wanted.hint("merge"), F.col("key") == F.col("label"), "left")
    joined = joined.withColumn("mark", F.xxhash64("packed"))
    half = F.when(F.col("mark") % 2 == 0, EVEN).otherwise(ODD)
    joined = joined.select("key", F.when(F.col("is_target"), half).otherwise(BACKGROUND).alias("part"), "mark", "n_tokens", "packed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, before = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            upto = before + np.cumsum(batch.column(3).to_numpy(zero_copy_only=False))
            number = first + np.concatenate([[before], upto])[:-1] // CHUNK_BYTES
            before = int(upto[-1]) if len(upto) else before
            yield pa.RecordBatch.from_arrays([pa.array(number), *batch.columns], ["chunk", *batch.schema.names])

    kind = joined.schema["key"].dataType.simpleString()
    return keep(joined.mapInArrow(run, f"chunk long, key {kind}, part int, mark long, n_tokens long, packed binary"), "texts")


def gram_counts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(chunk, gram, even, odd, background): occurrences of each n-gram of ``prepared`` texts in each part.

    A chunk that is read in two batches gives an n-gram of both twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(0).to_numpy()
            cuts = np.concatenate([[0], np.nonzero(np.diff(number))[0] + 1, [len(number)]])
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                data, offsets = _bytes(part.column(2), part.column(3))
                grams = _grams(data, offsets, order)
                parts = np.repeat(part.column(1).to_numpy(), np.diff(offsets))
                seen, n = np.unique(grams, return_counts=True)
                halves = []
                for half in (EVEN, ODD):
                    mine, m = np.unique(grams[parts == half], return_counts=True)
                    halves.append(np.zeros(len(seen), dtype=np.int64))
                    halves[-1][np.searchsorted(seen, mine)] = m
                found = [np.full(len(seen), number[lo]), seen.astype(np.int64), *halves, n - sum(halves)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["chunk", "gram", *COUNTED])

    schema = "chunk long, gram long, " + ", ".join(f"{c} long" for c in COUNTED)
    return texts.select("chunk", "part", "n_tokens", "packed").mapInArrow(run, schema)


def token_losses(counts: DataFrame, order: int = ORDER, prior: float = PRIOR) -> DataFrame:
    """(gram, target, even, odd, background): -log p of the last token of every n-gram, given those before it.

    ``counts`` are whole numbers (gram, even, odd, background) for each distinct n-gram; the target is
    both halves. The estimate of each order is drawn towards the next shorter one's, as if that had been
    seen ``prior`` times; the shortest towards all symbols alike. All models' counts are scaled to the
    target's number of tokens, so that the prior weighs alike in them. A model without texts knows nothing.
    """
    counts = counts.select("gram", (F.col("even") + F.col("odd")).alias("target"), *COUNTED)
    total = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in MODELS]).first()
    scale = {c: total.target / total[c] if total.target and total[c] else 1.0 for c in MODELS}

    def summed(df: DataFrame, gram: Column, *names: str) -> DataFrame:
        return df.groupBy(gram.alias("g")).agg(*[F.sum(c).alias(n) for c, n in zip(scale, names)])

    gram = F.col("gram")
    levels = [counts.select("gram", *scale)]
    for n in range(order - 1, 0, -1):
        shorter = summed(levels[0], gram.bitwiseAND((1 << 8 * n) - 1), *scale).withColumnRenamed("g", "gram")
        levels.insert(0, shorter)
    losses = None
    for own in levels:
        contexts = summed(own, F.shiftright("gram", 8), *[f"in_{c}" for c in scale])
        found = own.join(contexts, F.shiftright("gram", 8) == F.col("g")).drop("g")
        if losses is None:
            found = found.withColumns({f"p_{c}": F.lit(1.0 / SYMBOLS) for c in scale})
        else:
            size = levels.index(own)
            short = losses.select(F.col("gram").alias("g"), *[f"p_{c}" for c in scale])
            found = found.join(short, gram.bitwiseAND((1 << 8 * size) - 1) == F.col("g")).drop("g")
        losses = found.select("gram", *[
            ((F.col(c) * F.lit(s) + prior * F.col(f"p_{c}")) / (F.col(f"in_{c}") * F.lit(s) + prior)).alias(f"p_{c}") for c, s in scale.items()
        ])
    return losses.select("gram", *[(-F.log(f"p_{c}")).cast("float").alias(c) for c in scale])


def cross_entropy_difference(texts: DataFrame, needed: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, n_tokens, target_loss, background_loss, difference) of ``prepared`` texts, in nats for a token.

    ``needed`` are the losses (chunk, gram and a column per model) of the n-grams of each chunk. A document
    whose text is in one half of the target is scored by the model of the other one.
    """
    # The marks of the target's texts come to the chunks that hold such a text as rows without losses.
    target = texts.where(F.col("part") != BACKGROUND).select("mark").distinct()
    held = texts.select("chunk", "mark").distinct().join(target, "mark", "left_semi")
    needed = needed.unionByName(held.select("chunk", F.col("mark").alias("gram")), allowMissingColumns=True)
    kind = texts.schema["key"].dataType.simpleString()

    def run(own: pa.Table, given: pa.Table) -> pa.Table:
        own, given = own.combine_chunks(), given.combine_chunks()
        marked = pc.is_null(given.column("background"))
        mark, held = own.column("mark").to_numpy(), given.filter(marked).column("gram").to_numpy()
        given = given.filter(pc.invert(marked))
        half = np.where(np.isin(mark, held), np.where(mark % 2 == 0, EVEN, ODD), BACKGROUND)
        grams = given.column("gram").to_numpy()
        by = np.argsort(grams)
        data, offsets = _bytes(own.column("n_tokens"), own.column("packed"))
        at = by[np.searchsorted(grams[by], _grams(data, offsets, order).astype(np.int64))]
        n = np.diff(offsets)
        some = n > 0
        def mean(name: str) -> np.ndarray:
            sums = np.zeros(len(n))
            if some.any():
                sums[some] = np.add.reduceat(given.column(name).to_numpy()[at].astype(np.float64), offsets[:-1][some])
            return np.round(sums / np.maximum(n, 1), 9)

        target = mean("target")
        for mine, other in ((EVEN, "odd"), (ODD, "even")):
            if (half == mine).any():
                target = np.where(half == mine, mean(other), target)
        losses = [target, mean("background")]
        losses.append(np.round(losses[0] - losses[1], 9))
        return pa.table([own.column("key"), own.column("n_tokens"), *[pa.array(x, mask=~some) for x in losses]],
                        ["key", "n_tokens", "target_loss", "background_loss", "difference"])

    schema = f"key {kind}, n_tokens long, target_loss double, background_loss double, difference double"
    # Both sides are dealt to tasks whose number grows with the chunks.
    tasks = -(-texts.select("chunk").distinct().count() // TASK_CHUNKS)
    tasks = max(tasks, texts.sparkSession.sparkContext.defaultParallelism)
    own, given = (df.repartition(tasks, "chunk").groupBy("chunk") for df in (texts, needed))
    return own.cogroup(given).applyInArrow(run, schema)


def score_against(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", order: int = ORDER,
                  prior: float = PRIOR) -> DataFrame:
    """(key, n_tokens, target_loss, background_loss, difference) per document, the labelled ones being the target.

    A lower difference is nearer to the target. No text is scored by a target model that holds it: the
    target falls into two halves by text, each of which is scored by the other's model (so are copies that
    aren't labelled), all other texts by the model of both. Equal texts score alike. Where the other half
    has no text, its model knows nothing. All n-grams of all texts are counted in written tables,
    and a chunk of texts is joined with the losses of its distinct n-grams, so nothing is bounded by a
    table's size and nothing but two totals comes to the driver. Counts are whole numbers, so reruns
    agree. A null or empty text has no tokens and null losses; repeated rows come repeated; an empty
    table gives an empty result.
    """
    texts = prepared(docs, labels, key, text)
    found = keep(gram_counts(texts, order), "grams")
    counts = keep(found.groupBy("gram").agg(*[F.sum(c).alias(c) for c in COUNTED]), "counts")
    needed = found.select("chunk", "gram").join(token_losses(counts, order, prior), "gram")
    return cross_entropy_difference(texts, needed, order).withColumnRenamed("key", key)
