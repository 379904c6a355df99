"""A hierarchical Pitman-Yor language model of words, trained and applied in place.

Two levels of restaurants share parents: every context restaurant draws from the one root, the
root from the uniform distribution over the vocabulary. A context is the word before, by its hash
one of a fixed number. Customers are training words; the tables they sit at in a context
are the root's customers. Seatings are sampled by Gibbs sweeps, and a word's probability is the
average of the predictive ones over several seatings.

Words are dealt to buckets by their hash, so a bucket has all occurrences of its words and can
seat them in every context; what buckets need of each other are the totals of the contexts and of
the root, vectors of a fixed size. Words that are very frequent are dealt by word and context, and
their places in the root are totals, too. Occurrences travel once, packed by batch and bucket.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.shared import Stored, workers_find_package
from larder.llm.words import mixed, word_hashes

CONTEXTS = (1 << 16) - 1  # contexts by hash; one more stands for the start of a text
STRENGTH = 1.0
BURN_IN, SAMPLES = 2, 3
_EXACT_SEATS = 64  # customers seated one by one; later ones in steps of a 32nd of those seated
_CHUNK = 2048  # documents packed at a time
_END = b"\n"  # no word has a line end
_WAITING = 1 << 20  # documents whose sums a task holds at once
_DOCS = -1  # the bucket of the rows that describe documents
_PART = "bucket int, chunk long, data binary"


def _held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def _pack(**arrays: np.ndarray) -> bytes:
    """Arrays as one compressed text of bytes: their names, types and lengths, then their bytes."""
    head = json.dumps([(n, a.dtype.str, len(a)) for n, a in arrays.items()]).encode()
    parts = [len(head).to_bytes(4, "little"), head, *(np.ascontiguousarray(a).tobytes() for a in arrays.values())]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    at = 4 + int.from_bytes(raw[:4], "little")
    out = {}
    for name, kind, n in json.loads(raw[4:at]):
        out[name] = np.frombuffer(raw, kind, n, at)
        at += out[name].nbytes
    return out


def _runs(keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal values."""
    if not len(keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))


def _lengths(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n))


# --- occurrences ---------------------------------------------------------------------------


def _occurrences(n_buckets: int, hot: np.ndarray):
    """Packed occurrences of each batch of documents, a row for each bucket, and one that
    describes the documents."""
    end = word_hashes([_END])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        number = 0
        for batch in batches:
            for start in range(0, batch.num_rows, _CHUNK):
                yield _chunk(batch.slice(start, _CHUNK), (task << 24) + number)
                number += 1

    def _chunk(part: pa.RecordBatch, chunk: int) -> pa.RecordBatch:
        ids = part["doc_id"].to_pylist()
        held = np.array([_held_out(i) for i in ids])
        texts = [np.append(word_hashes((t.as_py() or "").encode().lower().split()), end) for t in part["text"]]
        n_tokens = np.array([len(t) for t in texts], np.int64)
        dishes = np.concatenate(texts)
        docs = np.repeat(np.arange(len(ids)), n_tokens)
        contexts = np.append(np.uint64(0), mixed(dishes[:-1]) % np.uint64(CONTEXTS)).astype(np.int64)
        contexts[np.cumsum(n_tokens) - n_tokens] = CONTEXTS
        words_here = pa.array(dishes).dictionary_encode()
        is_hot = np.isin(words_here.dictionary.to_numpy(), hot)[words_here.indices.to_numpy()]
        spread = np.where(is_hot, contexts % n_buckets + 1, 0).astype(np.uint64)
        found = pa.array(dishes + spread * np.uint64(0x9E3779B97F4A7C15)).dictionary_encode()
        which = found.indices.to_numpy()
        first = np.zeros(len(found.dictionary), np.int64)
        first[which[::-1]] = np.arange(len(which))[::-1]
        dish, bucket = dishes[first], (mixed(dishes[first] + spread[first]) % np.uint64(n_buckets)).astype(np.int64)
        order = np.lexsort((dish, bucket))  # distinct dishes by bucket
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        key = rank[which] * (CONTEXTS + 1) + contexts
        by_key = np.argsort(key, kind="stable")
        key, docs = key[by_key], docs[by_key]
        types = _runs(key)
        per_type = _lengths(types, len(key))
        type_dish, type_context = np.divmod(key[types], CONTEXTS + 1)
        types_of = _runs(type_dish)
        per_dish = _lengths(types_of, len(types))
        ends = np.searchsorted(bucket[order], np.arange(n_buckets + 1))  # dishes of each bucket
        type_ends = np.append(0, np.cumsum(per_dish))[ends]
        docs_ends = np.append(0, np.cumsum(per_type))[type_ends]
        rows = []
        for b in np.unique(bucket).tolist():
            d, t, o = (slice(e[b], e[b + 1]) for e in (ends, type_ends, docs_ends))
            rows.append((b, chunk, _pack(
                dish=dish[order][d], types=per_dish[d].astype(np.int32), context=type_context[t].astype(np.uint16),
                count=per_type[t].astype(np.int32), doc=docs[o].astype(np.uint16), held=held,
            )))
        none = np.iinfo(np.int64).min
        rows.append((_DOCS, chunk, _pack(
            doc_id=np.array([none if i is None else i for i in ids], np.int64),
            null=np.array([i is None for i in ids]), held=held, n_tokens=n_tokens,
        )))
        kinds = (pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "chunk", "data"]
        )

    return run


# --- state of a bucket ---------------------------------------------------------------------


@dataclass
class Bucket:
    """Dishes, types (a dish in a context) and occurrences, sorted by dish, context, chunk."""

    dish: np.ndarray  # hashes
    type_dish: np.ndarray  # place in ``dish`` of each type
    context: np.ndarray
    count: np.ndarray  # training customers of each type
    uses: np.ndarray  # occurrences of each type
    chunk: np.ndarray  # of each occurrence
    doc: np.ndarray

    @staticmethod
    def merged(parts: list[tuple[int, dict[str, np.ndarray]]]) -> Bucket:
        dish, context, uses, trained, chunk, doc = ([] for _ in range(6))
        for number, part in parts:
            dish.append(np.repeat(part["dish"], part["types"]))
            context.append(part["context"])
            uses.append(part["count"])
            owner = np.repeat(np.arange(len(part["count"])), part["count"])
            trained.append(np.bincount(owner, ~part["held"][part["doc"]], minlength=len(part["count"])))
            chunk.append(np.full(len(part["doc"]), number))
            doc.append(part["doc"])
        dish, context, uses = np.concatenate(dish), np.concatenate(context), np.concatenate(uses).astype(np.int64)
        trained, chunk, doc = np.concatenate(trained), np.concatenate(chunk), np.concatenate(doc)
        distinct, place = np.unique(dish, return_inverse=True)
        key = place.astype(np.int64) * (CONTEXTS + 1) + context
        order = np.argsort(key, kind="stable")
        starts = np.cumsum(uses) - uses
        moved = np.repeat(starts[order] - (np.cumsum(uses[order]) - uses[order]), uses[order]) + np.arange(len(doc))
        key, uses, trained = key[order], uses[order], trained[order]
        types = _runs(key)
        type_dish, type_context = np.divmod(key[types], CONTEXTS + 1)
        return Bucket(
            distinct, type_dish, type_context,
            np.add.reduceat(trained, types).astype(np.int64), np.add.reduceat(uses, types), chunk[moved], doc[moved],
        )

    def packed(self) -> bytes:
        chunks, number = np.unique(self.chunk, return_inverse=True)
        small = np.uint16 if len(chunks) <= 1 << 16 else np.uint32
        return _pack(
            dish=self.dish, types=np.bincount(self.type_dish, minlength=len(self.dish)).astype(np.int32),
            context=self.context.astype(np.uint16), count=self.count.astype(np.int32),
            uses=self.uses.astype(np.int32), chunks=chunks, chunk=number.astype(small), doc=self.doc.astype(np.uint16),
        )

    @staticmethod
    def unpacked(data: bytes) -> Bucket:
        p = _unpack(data)
        return Bucket(
            p["dish"], np.repeat(np.arange(len(p["dish"])), p["types"]), p["context"].astype(np.int64),
            p["count"].astype(np.int64), p["uses"].astype(np.int64), p["chunks"][p["chunk"]], p["doc"],
        )

    def per_dish(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.type_dish, values, minlength=len(self.dish))


@dataclass
class Totals:
    """What buckets share: of a fixed size, or one entry for each very frequent word."""

    customers: np.ndarray  # of each context
    tables: np.ndarray
    discount: float
    n_words: int  # distinct training words
    n_tokens: int
    hot: np.ndarray  # very frequent words, sorted
    hot_count: np.ndarray  # their training occurrences
    hot_tables: np.ndarray  # and tables in all contexts
    root_customers: float = 0.0
    root_tables: float = 0.0
    root_discount: float = 0.5
    strength: float = field(default=STRENGTH)


def seat(count: np.ndarray, first: np.ndarray, growth: np.ndarray, discount: float, draw) -> tuple[np.ndarray, np.ndarray]:
    """Seat the ``count`` customers of each dish in turn by the Chinese restaurant process.

    With t tables taken, a new one has weight ``first`` + ``growth`` t and the old ones together
    i - ``discount`` t. Returns the tables and the logarithm of the product of the weights the
    customers chose from; with it a seating is accepted or refused (``sweep``). Beyond the first
    customers, as many as fit a step small against those seated are seated at once.
    """
    order = np.argsort(-count, kind="stable")
    c, a, g = count[order], first[order], growth[order]
    t = np.minimum(c, 1).astype(np.float64)
    weight = np.log(np.maximum(a, 1e-300)) * t
    seated = 1
    while len(c) and seated < c[0]:
        n = int(np.searchsorted(-c, -seated, side="left"))  # dishes with more customers
        step = 1 if seated < _EXACT_SEATS else seated // 32
        now = np.minimum(step, c[:n] - seated)
        new = a[:n] + g[:n] * t[:n]
        every = seated - discount * t[:n] + new
        share = np.minimum(new / every, 1.0)
        weight[:n] += now * np.log(every)
        t[:n] += draw.random(n) < share if step == 1 else draw.binomial(now, share)
        seated += step
    tables, weights = np.empty(len(count)), np.empty(len(count))
    tables[order], weights[order] = t, weight
    return tables, weights


class Seating:
    """Tables of a bucket's types and of its dishes in the root."""

    def __init__(self, bucket: Bucket, totals: Totals, seed: int):
        self.bucket, self.totals = bucket, totals
        self.draw = np.random.default_rng(seed)
        self.tables = (bucket.count > 0).astype(np.float64)
        self.weights = np.full(len(bucket.count), -np.inf)
        place = np.searchsorted(totals.hot, bucket.dish)
        self.is_hot = np.zeros(len(bucket.dish), bool)
        if len(totals.hot):
            place = np.minimum(place, len(totals.hot) - 1)
            self.is_hot = totals.hot[place] == bucket.dish
        self.hot_place = place
        #: what the other buckets have of the tables of contexts and of very frequent words
        self.others = np.maximum(
            totals.tables - np.bincount(bucket.context, self.tables, minlength=CONTEXTS + 1), 0
        )
        self._seat_root()

    def _root_customers(self) -> np.ndarray:
        own = self.bucket.per_dish(self.tables)
        if self.is_hot.any():
            own[self.is_hot] = self.totals.hot_tables[self.hot_place[self.is_hot]]
        return own

    def _seat_root(self) -> None:
        t = self.totals
        self.customers = self._root_customers()
        base = 1.0 / (t.n_words + 1)
        new = np.full(len(self.customers), base)
        self.root_tables, _ = seat(
            self.customers.astype(np.int64), new * (t.strength + t.root_discount * t.root_tables),
            new * t.root_discount, t.root_discount, self.draw,
        )
        d, s = t.root_discount, t.strength
        self.root = (
            np.maximum(self.customers - d * self.root_tables, 0) + (s + d * t.root_tables) * base
        ) / (s + max(t.root_customers, 1.0))

    def sweep(self) -> None:
        """A Gibbs sweep: the customers of each dish leave a context and are seated anew; the new
        seating replaces the old one with the probability that keeps the posterior unchanged."""
        b, t = self.bucket, self.totals
        free = np.flatnonzero(b.count > 1)
        in_context = self.others + np.bincount(b.context, self.tables, minlength=CONTEXTS + 1)
        parent = self.root[b.type_dish[free]]
        first = parent * (t.strength + t.discount * np.maximum(in_context[b.context[free]] - self.tables[free], 0))
        tables, weights = seat(b.count[free], first, parent * t.discount, t.discount, self.draw)
        taken = np.log(self.draw.random(len(free))) < weights - self.weights[free]
        self.tables[free[taken]] = tables[taken]
        self.weights[free[taken]] = weights[taken]
        self._seat_root()

    def probabilities(self) -> np.ndarray:
        """Predictive probability of each type."""
        b, t = self.bucket, self.totals
        in_context = self.others + np.bincount(b.context, self.tables, minlength=CONTEXTS + 1)
        customers = t.customers[b.context]
        parent = self.root[b.type_dish]
        own = np.maximum(b.count - t.discount * self.tables, 0)
        return (own + (t.strength + t.discount * in_context[b.context]) * parent) / (t.strength + customers)


# --- the passes ----------------------------------------------------------------------------


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One packed bucket from its packed occurrences; rows come sorted by bucket and chunk.
    Rows that describe documents pass through."""
    waiting: list[tuple[int, dict]] = []
    current = None

    def done() -> pa.RecordBatch:
        data = Bucket.merged(waiting).packed()
        return _part_row(current, 0, data)

    for batch in batches:
        for bucket, chunk, data in zip(*(batch[c] for c in ("bucket", "chunk", "data"))):
            bucket, chunk, data = bucket.as_py(), chunk.as_py(), data.as_py()
            if bucket == _DOCS:
                yield _part_row(_DOCS, chunk, data)
                continue
            if bucket != current and waiting:
                yield done()
                waiting = []
            current = bucket
            waiting.append((chunk, _unpack(data)))
    if waiting:
        yield done()


def _part_row(bucket: int, chunk: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int32()), pa.array([chunk], pa.int64()), pa.array([data], pa.binary())],
        names=["bucket", "chunk", "data"],
    )


def _counted(shared):
    """What a bucket adds to the totals, as rows (kind, key, customers, tables).

    Kinds: 0 a context; 1 a very frequent word; 2 words that are not; 3 the root; 4 numbers of
    types with one and with two customers. With totals given, after sweeps with them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, totals, sweeps = shared.value
        for batch in batches:
            for number, data in zip(batch["bucket"], batch["data"]):
                bucket = Bucket.unpacked(data.as_py())
                tables = (bucket.count > 0).astype(np.float64)
                root_tables = 0.0
                is_hot = np.isin(bucket.dish, hot)
                if totals is not None:
                    seating = Seating(bucket, totals, number.as_py())
                    for _ in range(sweeps):
                        seating.sweep()
                    tables = seating.tables
                    root_tables = float(seating.root_tables[~is_hot].sum())
                else:
                    root_tables = float((bucket.per_dish(bucket.count)[~is_hot] > 0).sum())
                counts, own_tables = bucket.per_dish(bucket.count), bucket.per_dish(tables)
                n, m = (np.bincount(bucket.context, v, minlength=CONTEXTS + 1) for v in (bucket.count, tables))
                used = np.flatnonzero(n)
                kinds = [np.zeros(len(used)), np.ones(is_hot.sum()), [2, 3, 4]]
                keys = [used, bucket.dish[is_hot].view(np.int64), [0, 0, 0]]
                cold = counts[~is_hot]
                customers = [n[used], counts[is_hot], [cold.sum(), own_tables[~is_hot].sum(), (bucket.count == 1).sum()]]
                tabled = [m[used], own_tables[is_hot], [(cold > 0).sum(), root_tables, (bucket.count == 2).sum()]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(kinds).astype(np.int32)), pa.array(np.concatenate(keys).astype(np.int64)),
                        pa.array(np.concatenate(customers).astype(np.int64)), pa.array(np.concatenate(tabled).astype(np.int64)),
                    ],
                    names=["kind", "key", "customers", "tables"],
                )

    return run


class _Sums:
    """Sums of documents, combined over the buckets of a task before they travel.

    What waits is bounded: beyond ``limit`` documents the combined sums are handed on.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.key = np.zeros(0, np.int64)
        self.sums = [np.zeros(0) for _ in range(3)]

    def add(self, key: np.ndarray, sums: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        both = np.append(self.key, key)
        self.key, place = np.unique(both, return_inverse=True)
        self.sums = [
            np.bincount(place, np.append(a, b), minlength=len(self.key)) for a, b in zip(self.sums, sums)
        ]
        if len(self.key) > self.limit:
            yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        """A packed row for each chunk, 512 chunks to a batch; nothing waits after it."""
        chunks, doc = self.key >> 16, (self.key & 0xFFFF).astype(np.uint16)
        known, base, score = self.sums
        starts = _runs(chunks)
        ends = np.append(starts[1:], len(chunks))
        self.__init__(self.limit)
        for first in range(0, len(starts), 512):
            some = slice(first, first + 512)
            packed = [
                _pack(doc=doc[a:b], known=known[a:b].astype(np.int32), base=base[a:b], score=score[a:b])
                for a, b in zip(starts[some].tolist(), ends[some].tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunks[starts[some]]), pa.array(packed, pa.binary())], names=["chunk", "data"]
            )


def _scores(shared, samples: int, sweeps: int, limit: int = _WAITING):
    """Sums of the logarithms for each document, over the buckets of a task, packed by chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, waiting = shared.value, _Sums(limit)
        for batch in batches:
            for number, data in zip(batch["bucket"], batch["data"]):
                bucket = Bucket.unpacked(data.as_py())
                seating = Seating(bucket, totals, number.as_py())
                for _ in range(sweeps):
                    seating.sweep()
                p = np.zeros(len(bucket.count))
                for _ in range(samples):
                    seating.sweep()
                    p += seating.probabilities()
                counts = bucket.per_dish(bucket.count)
                if seating.is_hot.any():
                    counts[seating.is_hot] = totals.hot_count[seating.hot_place[seating.is_hot]]
                base = np.log10((counts + 1) / (totals.n_tokens + totals.n_words + 1))[bucket.type_dish]
                model = np.log10(p / samples)
                known = (counts > 0)[bucket.type_dish]
                owner = np.repeat(np.arange(len(bucket.uses)), bucket.uses)
                key, place = np.unique(bucket.chunk * (1 << 16) + bucket.doc, return_inverse=True)
                yield from waiting.add(key, [np.bincount(place, v[owner], minlength=len(key)) for v in (known, base, model)])
        yield from waiting.rows()

    return run


def _results(train_tokens: int):
    """The rows of documents, from their descriptions and, after each, the sums of its chunk."""

    def finished(p: dict, sums: list[np.ndarray]) -> pa.RecordBatch:
        n_tokens, (known, base, score) = p["n_tokens"], sums
        return pa.RecordBatch.from_arrays(
            [
                pa.array(p["doc_id"], pa.int64(), mask=p["null"]), pa.array(p["held"]), pa.array(n_tokens),
                pa.array(known.astype(np.int64)), pa.array(np.full(len(known), train_tokens)),
                pa.array(base), pa.array(score), pa.array(10.0 ** (-score / n_tokens)),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        described, sums = None, []
        for batch in batches:
            for part, data in zip(batch["part"].to_pylist(), batch["data"]):
                p = _unpack(data.as_py())
                if part == 0:
                    if described is not None:
                        yield finished(described, sums)
                    described, sums = p, [np.zeros(len(p["doc_id"])) for _ in range(3)]
                else:
                    for total, name in zip(sums, ("known", "base", "score")):
                        total[p["doc"]] += p[name]  # a document once in a part
        if described is not None:
            yield finished(described, sums)

    return run


def _frequent(docs: DataFrame, n_buckets: int) -> np.ndarray:
    """Hashes of words that a look at some documents finds so frequent that one of them would
    fill a quarter of a bucket. It decides only where words are dealt, not what is computed."""
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(64)) == 0)
    words = F.concat(F.split(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "), " "), F.array(F.lit(_END.decode())))
    lower = F.translate("word", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = some.select(F.explode(words).alias("word")).groupBy(lower.alias("word")).count()
    total = some.select(F.sum(F.size(words)).alias("n")).first()["n"] or 0
    found = counts.where(F.col("count") >= max(1.0, total * 0.25 / n_buckets)).select("word").collect()
    hashes = [xxhash.xxh64_intdigest(r["word"].encode(), 42) for r in found]
    return np.unique(np.array([*hashes, *word_hashes([_END]).tolist()], np.uint64))


def _totals(state: DataFrame, shared, hot: np.ndarray, before: Totals | None) -> Totals:
    rows = (
        state.mapInArrow(_counted(shared), "kind int, key long, customers long, tables long")
        .groupBy("kind", "key")
        .agg(F.sum("customers").alias("customers"), F.sum("tables").alias("tables"))
        .toPandas()
    )
    contexts, words = rows[rows.kind == 0], rows[rows.kind == 1]
    one = {int(r.kind): r for r in rows[rows.kind > 1].itertuples()}
    customers, tables = np.zeros(CONTEXTS + 1), np.zeros(CONTEXTS + 1)
    customers[contexts.key.to_numpy()] = contexts.customers
    tables[contexts.key.to_numpy()] = contexts.tables
    hot_count, hot_tables = np.zeros(len(hot), np.int64), np.zeros(len(hot), np.int64)
    place = np.searchsorted(hot, words.key.to_numpy().view(np.uint64))
    hot_count[place], hot_tables[place] = words.customers, words.tables
    if not one:
        return Totals(customers, tables, 0.5, 0, 0, hot, hot_count, hot_tables)
    n1, n2 = int(one[4].customers), int(one[4].tables)
    totals = Totals(
        customers, tables,
        discount=min(0.95, max(0.05, n1 / max(n1 + 2 * n2, 1))),
        n_words=int(one[2].tables) + int((hot_count > 0).sum()),
        n_tokens=int(one[2].customers) + int(hot_count.sum()),
        hot=hot, hot_count=hot_count, hot_tables=hot_tables,
        root_customers=float(one[3].customers + hot_tables.sum()),
        root_tables=float(one[3].tables + (hot_count > 0).sum()),
    )
    if before is not None:
        totals.discount = before.discount
    return totals


def scored(docs: DataFrame, burn_in: int = BURN_IN, samples: int = SAMPLES, n_buckets: int | None = None) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``) with its logarithmic probability.

    Tokens are the words between ASCII white space, A-Z in lower case, and one end. Rows whose id
    has a crc32 (as text) that leaves 2 when divided by 7 are ``held_out``; the others are learned
    from. Returns ``doc_id``, ``held_out``, ``n_tokens``, ``n_known`` (tokens seen in training),
    ``train_tokens``, ``base_score`` (the add-one unigram model over training words and one for
    all others), ``score`` (this model, which shares that vocabulary) and ``perplexity`` of the
    score. A null text is an empty one: its end alone. A row with a null id is learned from;
    repeated rows stay and count each; without rows the result is empty. Words are told apart by
    64-bit hashes. A bucket is one task's work: ``n_buckets`` (by default two to a shuffle
    partition) should grow with the corpus.
    """
    spark = docs.sparkSession
    workers_find_package(spark)
    stored = Stored(spark, "lm")
    n_buckets = n_buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hot = _frequent(read, n_buckets)
    dealt = read.mapInArrow(_occurrences(n_buckets, hot), _PART)
    spread = F.when(F.col("bucket") == _DOCS, F.col("chunk")).otherwise(F.lit(0))
    state = stored.write(
        dealt.repartition("bucket", spread).sortWithinPartitions("bucket", "chunk").mapInArrow(_merge, _PART)
    )
    buckets = state.where(F.col("bucket") != _DOCS)
    totals = _shared_totals(spark, buckets, hot, None, 0)
    totals = _shared_totals(spark, buckets, hot, totals, burn_in)
    sums = buckets.mapInArrow(
        _scores(spark.sparkContext.broadcast(totals), samples, burn_in), "chunk long, data binary"
    )
    described = state.where(F.col("bucket") == _DOCS).select(F.lit(0).alias("part"), "chunk", "data")
    parts = described.unionByName(sums.select(F.lit(1).alias("part"), "chunk", "data"))
    return parts.repartition("chunk").sortWithinPartitions("chunk", "part").mapInArrow(
        _results(totals.n_tokens),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, perplexity double",
    )


def _shared_totals(spark: SparkSession, buckets: DataFrame, hot: np.ndarray, before: Totals | None, sweeps: int) -> Totals:
    return _totals(buckets, spark.sparkContext.broadcast((hot, before, sweeps)), hot, before)
