"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability comes from a linear model over its
words; the document's is the noisy-or of them, the probability that not every sentence is clean.
The model is trained from document labels only, through the noisy-or, and then names the
sentences that offend.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.shared import Stored, workers_find_package

_SENTENCE = re.compile(r"[^.!?\n]+")
_EDGES = "\"'()[]{}<>,;:*&%$#|-_=+"
SLOTS = 1 << 18  # weights; every feature of a word falls into one by its hash
#: At most so many labelled documents are learned from, those with the smallest hash of their id.
MOST_TRAINED = 20_000
SHARDS = 8
#: A shard takes no further documents beyond so many words' slots.
MOST_SLOTS = 20_000_000
ROUNDS, STEPS, _BATCH = 6, 120, 16
_RATE, _DECAY, _START, _SQUARES = 0.5, 1e-5, -6.0, 0.1
_KNOWN_WORDS = 1 << 17  # words whose score or slots a task keeps
PREDICT_AT = 0.3


def held_out(doc_id: Column, modulus: int = 4, remainder: int = 2) -> Column:
    """Whether crc32 of the id as text leaves the remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Start, length and words of each sentence that has words."""
    for found in _SENTENCE.finditer(text):
        words = found[0].lower().split()
        if words:
            yield found.start(), found.end() - found.start(), words


def features(word: str) -> list[int]:
    """Slots of a word: itself and its first 3, 4, 5 and 6 letters."""
    word = word.strip(_EDGES) or word
    parts = [f"={word}", *(f"^{word[:n]}" for n in range(3, 7) if len(word) >= n)]
    return [xxhash.xxh32_intdigest(p) % SLOTS for p in parts]


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self._scores: dict[str, float] = {}

    def word_score(self, word: str) -> float:
        score = self._scores.get(word)
        if score is None:
            if len(self._scores) >= _KNOWN_WORDS:
                self._scores.clear()
            score = self._scores[word] = float(self.weights[features(word)].sum())
        return score

    def sentence_logits(self, text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
        places, logits = [], []
        known, miss = self._scores.get, self.word_score
        for start, length, words in sentences(text):
            scores = map(known, words)
            total = sum(miss(w) if s is None else s for w, s in zip(words, scores))
            places.append((start, length))
            logits.append(total)
        return places, np.array(logits) + self.bias

    def score(self, text: str) -> float:
        """Noisy-or of the sentences; of a text without any, that of one empty sentence."""
        _, logits = self.sentence_logits(text)
        return noisy_or(logits if len(logits) else np.array([self.bias]))


def noisy_or(logits: np.ndarray) -> float:
    """1 - prod(1 - p), with log(1 - p) = -log(1 + exp(logit))."""
    return float(-np.expm1(-np.logaddexp(0.0, logits).sum()))


# --- training ------------------------------------------------------------------------------


def _training_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """Labelled documents that are not held out, with their features: ``doc_id``, ``toxic``,
    ``slots`` of all words and ``sizes``, the number of slots of each sentence."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    read = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # ``most`` rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, list[int]] = {}
        for batch in batches:
            slots, sizes = [], []
            for text in batch["text"]:
                own, counts = [], []
                for _, _, words in sentences(text.as_py() or ""):
                    before = len(own)
                    for word in words:
                        found = cache.get(word)
                        if found is None:
                            if len(cache) >= _KNOWN_WORDS:
                                cache.clear()
                            found = cache[word] = features(word)
                        own += found
                    counts.append(len(own) - before)
                slots.append(np.array(own, np.int32))
                sizes.append(np.array(counts, np.int32))
            if slots:
                kind = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].cast(pa.int64()), batch["toxic"], pa.array(slots, kind), pa.array(sizes, kind)],
                    names=["doc_id", "toxic", "slots", "sizes"],
                )

    return read.mapInArrow(run, "doc_id long, toxic int, slots array<int>, sizes array<int>")


def _descend(bags: list[tuple[int, np.ndarray, np.ndarray]], weights: np.ndarray, bias: float, squares: np.ndarray) -> float:
    """One step over some documents, in place; returns the new bias.

    The loss is the logarithmic one of the noisy-or. Its slope in a sentence's logit is p for a
    clean document and -p (1 - P) / P for a toxic one.
    """
    slots = np.concatenate([b[1] for b in bags])
    sizes = np.concatenate([b[2] for b in bags])
    owner = np.repeat(np.arange(len(bags)), [len(b[2]) for b in bags])
    starts = np.cumsum(sizes) - sizes
    logits = np.add.reduceat(np.append(weights[slots], 0.0), starts) + bias
    clean = -np.logaddexp(0.0, logits)  # log(1 - p)
    p = -np.expm1(clean)
    total = np.bincount(owner, clean, minlength=len(bags))
    toxic = np.array([b[0] for b in bags])
    share = np.exp(total) / np.maximum(-np.expm1(total), 1e-12)
    slope = np.where(toxic[owner] == 1, -p * np.minimum(share[owner], 1 / np.maximum(p, 1e-12)), p) / len(bags)
    gradient = np.bincount(slots, np.repeat(slope, sizes), minlength=len(weights))
    touched = np.flatnonzero(gradient)
    step = gradient[touched] + _DECAY * weights[touched]
    squares[touched] += step * step
    weights[touched] -= _RATE * step / (np.sqrt(squares[touched]) + 1e-8)
    g = slope.sum()
    squares[-1] += g * g
    return bias - _RATE * g / (np.sqrt(squares[-1]) + 1e-8)


def _round(number: int, shared):
    """So many steps of each shard over its documents, again and again in shuffled order, from
    the weights with which all shards begin. Rows come sorted by shard."""

    def trained(bags: list[tuple]) -> pa.RecordBatch:
        weights, bias, squares = (x.copy() if isinstance(x, np.ndarray) else x for x in shared.value)
        draw = np.random.default_rng(number)
        order = np.concatenate([draw.permutation(len(bags)) for _ in range(-(-STEPS * _BATCH // len(bags)))])
        for k in range(STEPS):
            bias = _descend([bags[i] for i in order[k * _BATCH : (k + 1) * _BATCH]], weights, bias, squares)
        packed = [pa.array([x.astype(np.float32).tobytes()]) for x in (weights, squares)]
        return pa.RecordBatch.from_arrays(
            [pa.array([len(bags)], pa.int64()), packed[0], pa.array([bias]), packed[1]],
            names=["n", "weights", "bias", "squares"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags, n_slots, current = [], 0, None
        for batch in batches:
            for shard, toxic, slots, sizes in zip(*(batch[c] for c in ("shard", "toxic", "slots", "sizes"))):
                if shard != current and bags:
                    yield trained(bags)
                    bags, n_slots = [], 0
                current = shard
                if len(sizes.values) and n_slots < MOST_SLOTS:
                    bags.append((toxic.as_py(), np.array(slots.values), np.array(sizes.values)))
                    n_slots += len(slots.values)
        if bags:
            yield trained(bags)

    return run


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_TRAINED, rounds: int = ROUNDS) -> Model:
    """Learn from at most ``most`` labelled documents that are not held out.

    The documents are dealt into shards by id. In each round every shard takes the same number of
    steps over its documents from the same weights, and the results are averaged by the number of
    documents; the driver holds the weights of the shards, a fixed size. A shard that has
    ``MOST_SLOTS`` features takes no more documents. Several labels of one document
    count as the largest; several documents of one id all have its label. Without labels the
    model gives every text a small probability.
    """
    spark = docs.sparkSession
    workers_find_package(spark)
    stored = Stored(spark, "toxicity")
    weights, bias, squares = np.zeros(SLOTS), _START, np.full(SLOTS + 1, _SQUARES)
    shard = F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(SHARDS)).cast("int")
    rows = _training_rows(docs, labels, most).withColumn("shard", shard).repartition(SHARDS, "shard")
    # A file holds whole shards in order, so that the rounds read them without another shuffle.
    dealt = stored.write(rows.sortWithinPartitions("shard", F.xxhash64("doc_id"), "doc_id"))
    for number in range(rounds):
        shared = spark.sparkContext.broadcast((weights, bias, squares))
        results = dealt.mapInArrow(
            _round(number, shared), "n long, weights binary, bias double, squares binary"
        ).collect()
        shared.unpersist()
        if not results:
            break
        share = np.array([r["n"] for r in results], float)
        share /= share.sum()
        weights = sum(s * np.frombuffer(r["weights"], np.float32) for s, r in zip(share, results))
        squares = sum(s * np.frombuffer(r["squares"], np.float32) for s, r in zip(share, results))
        bias = float(sum(s * r["bias"] for s, r in zip(share, results)))
    stored.clear()
    return Model(weights, bias)


# --- scoring -------------------------------------------------------------------------------


def scored(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), offending_at: float = 0.2) -> DataFrame:
    """Columns ``keep`` of every row of ``docs`` with the ``score`` of its whole text and
    ``offending``, the sentences of at least that probability: their starts (in code points)
    and lengths. A null text counts as empty, an empty one as one empty sentence. No row is
    shuffled."""
    spark = docs.sparkSession
    workers_find_package(spark)
    shared = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))
    read = docs.select(*keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema if f.name in keep)
    least = float(np.log(offending_at / (1 - offending_at)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        spans = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
        for batch in batches:
            scores, offending = [], []
            for text in batch["text"]:
                places, logits = own.sentence_logits(text.as_py() or "")
                scores.append(noisy_or(logits if len(logits) else np.array([own.bias])))
                offending.append([{"start": s, "length": n} for (s, n), x in zip(places, logits) if x >= least])
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in keep), pa.array(scores, pa.float64()), pa.array(offending, spans)],
                names=[*keep, "score", "offending"],
            )

    return read.mapInArrow(run, f"{schema}, score double, offending array<struct<start:int,length:int>>")


def toxic_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``) with its toxicity.

    Returns ``doc_id``, ``held_out`` (crc32 of the id as text leaves 2 when divided by 4; such
    rows are not learned from), ``score`` from 0 to 1, ``predicted``, 1 from a score of 0.3 on,
    and ``offending``, the sentences at fault. Ids, languages, sources and labels are no inputs
    of a score. Rows with a null id are scored and never learned from; repeated rows stay; a
    table without rows gives none.
    """
    model = train(docs, labels, **options)
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"),
        "offending",
    )


def without_toxic(docs: DataFrame, model: Model, reject_at: float = PREDICT_AT) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is below ``reject_at``. No row
    is shuffled."""
    workers_find_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            clean = [own.score(t.as_py() or "") < reject_at for t in batch["text"]]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
