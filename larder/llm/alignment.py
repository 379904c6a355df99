"""Two tokenizers' tokens of the same text, aligned by the bytes they cover.

The byte offsets at which tokens of both end cut a text into groups. A range of a text yields a
fragment: the tokens before its first cut (open), its closed groups, the tokens after its last cut
(open). Fragments are composed in any grouping with the same result, so the ranges of a very long
text are aligned in tasks of their own and put together as a tree.

How many documents hold a pair of linked ids is counted over dictionaries of blocks of documents,
so a pair travels once a block, not once a document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.bpe import in_batches
from larder.llm.packing import encoder
from larder.llm.shared import Stored, workers_find_package

RANGE = 1 << 16  # characters of a text that one task takes at least
_BLOCK = 1 << 21  # pairs of documents in a block
_CHARACTERS = 1 << 21  # characters aligned at once
_FAN = 8  # neighbouring fragments composed at once
_BITS = 20  # of an id; a pair has twice as many, a document's number in a block the rest
_ROWS = 1 << 16


# --- Fragments --------------------------------------------------------------------------


@dataclass(frozen=True)
class Tokens:
    """Tokens of both tokenizers over one range of a text: ids and the offsets where they end."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate(both) for both in zip(self.parts(), other.parts())))

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.a, self.a_ends, self.b, self.b_ends

    def between(self, low: int, high: int) -> Tokens:
        """Those that end above ``low`` and not above ``high``."""
        i, j = np.searchsorted(self.a_ends, [low, high], "right")
        k, m = np.searchsorted(self.b_ends, [low, high], "right")
        return Tokens(self.a[i:j], self.a_ends[i:j], self.b[k:m], self.b_ends[k:m])


NO_TOKENS = Tokens(*(np.zeros(0, np.int64) for _ in range(4)))
_END = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Fragment:
    """What is open at both sides of a range; without a cut in it, ``suffix`` is None and all of
    it is ``prefix``. The empty range is ``Fragment(NO_TOKENS, None)``."""

    prefix: Tokens
    suffix: Tokens | None


def fragment(tokens: Tokens) -> tuple[Fragment, Tokens]:
    """The fragment of a range, and the tokens of its closed groups."""
    cuts = np.intersect1d(tokens.a_ends, tokens.b_ends, assume_unique=True)
    if not len(cuts):
        return Fragment(tokens, None), NO_TOKENS
    first, last = int(cuts[0]), int(cuts[-1])
    return Fragment(tokens.between(-1, first), tokens.between(last, _END)), tokens.between(first, last)


def composed(f: Fragment, g: Fragment) -> tuple[Fragment, Tokens]:
    """The fragment of a range followed by another, and the groups that close where they meet."""
    if f.suffix is None:
        joint, closed = fragment(f.prefix + g.prefix)
        return (joint if g.suffix is None else Fragment(joint.prefix, g.suffix)), closed
    if g.suffix is not None:
        return Fragment(f.prefix, g.suffix), f.suffix + g.prefix
    joint, closed = fragment(f.suffix + g.prefix)
    if joint.suffix is None:
        return Fragment(f.prefix, joint.prefix), NO_TOKENS
    return Fragment(f.prefix, joint.suffix), joint.prefix + closed


# --- The two tokenizers -----------------------------------------------------------------


class Tokenizers:
    """A byte-level BPE file (a) and a sentencepiece model (b)."""

    def __init__(self, path_a: str, path_b: str):
        import json

        import sentencepiece

        from larder.llm.bpe import byte_letters

        self.encode_a = encoder(path_a, True)
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        added = {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.a_bytes = [b""] * (max([*vocab.values(), *added]) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if set(token) <= letters.keys() else token.encode()
        for i, token in added.items():
            self.a_bytes[i] = token.encode()

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        shown = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(shown)
        ]
        # No piece has a space after another character, so a text may be cut before such a space.
        self.cut_before_spaces = not any("▁" in p.lstrip("▁") for p in shown)
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << _BITS:
            raise ValueError("vocabularies of more than a million ids are not supported")
        self.a_lengths = np.array([len(b) for b in self.a_bytes])
        self.b_lengths = np.array([len(b) for b in self.b_bytes])
        shown_a, shown_b = [str(i) for i in range(len(self.a_bytes))], [str(i) for i in range(len(self.b_bytes))]
        self.shown = [s + mark for names, marks in ((shown_a, ",|"), (shown_b, ",;")) for mark in marks for s in names]

    def ids(self, text_a: str, text_b: str, expected_a: bytes, expected_b: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of ``text_a`` by a and of ``text_b``, which b begins with a space, by b; None if
        their bytes are not the expected ones."""
        a, b = self.encode_a(text_a), self.pieces.encode(text_b)
        if b"".join(map(self.a_bytes.__getitem__, a)) != expected_a:
            return None
        if b"".join(map(self.b_bytes.__getitem__, b)) != expected_b:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


@lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


class Aligned:
    """Whole groups of one or more documents, one after another in one row of bytes.

    ``last_a`` and ``last_b`` mark the tokens that end a group. Every stretch of bytes between
    neighbouring ends of either tokenizer lies in one token of each: that is a link.
    """

    def __init__(self, tokens: Tokens):
        self.tokens = tokens
        a_ends, b_ends = tokens.a_ends, tokens.b_ends
        at = np.minimum(np.searchsorted(b_ends, a_ends), max(len(b_ends) - 1, 0))
        self.last_a = b_ends[at] == a_ends if len(b_ends) else np.zeros(0, bool)
        at = np.minimum(np.searchsorted(a_ends, b_ends), max(len(a_ends) - 1, 0))
        self.last_b = a_ends[at] == b_ends if len(a_ends) else np.zeros(0, bool)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of a and b of every link, by their places."""
        t = self.tokens
        ends = np.union1d(t.a_ends, t.b_ends)
        return np.searchsorted(t.a_ends, ends), np.searchsorted(t.b_ends, ends)

    def shown(self, names: list[str], n_a: int, n_b: int) -> list[str]:
        """Every token's id with the mark that follows it, in the order of the groups."""
        t = self.tokens
        group_a = np.cumsum(self.last_a) - self.last_a
        group_b = np.cumsum(self.last_b) - self.last_b
        n_groups = int(self.last_a.sum())
        a_until = np.cumsum(np.bincount(group_a, minlength=n_groups))
        b_until = np.cumsum(np.bincount(group_b, minlength=n_groups))
        b_before = np.concatenate([[0], b_until])
        order = np.empty(len(t.a) + len(t.b), np.int64)
        order[np.arange(len(t.a)) + b_before[group_a]] = t.a + self.last_a * n_a
        order[np.arange(len(t.b)) + a_until[group_b]] = 2 * n_a + t.b + self.last_b * n_b
        return list(map(names.__getitem__, order.tolist()))


def _packed(pairs: np.ndarray, kind: str) -> bytes:
    return pairs.astype(kind).tobytes()


# --- Documents of one range -------------------------------------------------------------

_BLOCK_SCHEMA = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, digest array<string>, "
    "n_pairs array<long>, place binary, times binary, pairs binary, holders binary"
)


class _Block:
    """Documents with their distinct pairs, until there are enough."""

    def __init__(self):
        self.rows: list[tuple] = []  # doc_id, n_a, n_b, n_groups, digest
        self.n_pairs: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.size = 0

    def add(self, rows: list[tuple], n_pairs: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> None:
        self.rows += rows
        self.n_pairs.append(n_pairs)
        self.pairs.append(pairs)
        self.times.append(times)
        self.size += len(pairs) + len(rows)

    def record(self, number: int) -> tuple:
        pairs, place = np.unique(np.concatenate(self.pairs), return_inverse=True)
        holders = np.bincount(place, minlength=len(pairs))
        columns = [list(c) for c in zip(*self.rows)]
        return (
            number, *columns, np.concatenate(self.n_pairs).tolist(), _packed(place, "<u4"),
            _packed(np.concatenate(self.times), "<u4"), _packed(pairs, "<i8"), _packed(holders, "<u4"),
        )


def _aligned_batch(known: Tokenizers, docs: list[tuple]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
    """Rows, numbers of distinct pairs, these pairs and their occurrences for (doc_id, text)."""
    ids = []
    for _, text in docs:
        whole = b" " + text.encode() if text else b""
        ids.append((known.ids(" " + text, text, whole, whole) if text else None) or (NO_TOKENS.a, NO_TOKENS.b))
    a, b = np.concatenate([i[0] for i in ids]), np.concatenate([i[1] for i in ids])
    n_a, n_b = np.array([len(i[0]) for i in ids]), np.array([len(i[1]) for i in ids])
    # Both tokenizers cover the same bytes of every document, so these lie end to end.
    joined = Aligned(Tokens(a, np.cumsum(known.a_lengths[a]), b, np.cumsum(known.b_lengths[b])))
    document = np.repeat(np.arange(len(docs)), n_a)
    n_groups = np.bincount(document, joined.last_a, len(docs)).astype(np.int64)
    at_a, at_b = joined.links()
    keys, times = np.unique((document[at_a] << 2 * _BITS) | (a[at_a] << _BITS) | b[at_b], return_counts=True)
    n_pairs = np.bincount(keys >> 2 * _BITS, minlength=len(docs))
    shown = joined.shown(known.shown, len(known.a_bytes), len(known.b_bytes))
    rows, start = [], 0
    for (doc_id, _), x, y, g in zip(docs, n_a.tolist(), n_b.tolist(), n_groups.tolist()):
        text = "".join(shown[start : start + x + y])[:-1]
        rows.append((doc_id, x, y, g, hashlib.sha256(text.encode()).hexdigest() if x else ""))
        start += x + y
    return rows, n_pairs, keys & ((1 << 2 * _BITS) - 1), times


def _blocks(docs: DataFrame, path_a: str, path_b: str, block: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizers(path_a, path_b)
        base = TaskContext.get().partitionId() << 32

        def records() -> Iterator[tuple]:
            number, held, waiting, size = base, _Block(), [], 0
            for batch in batches:
                for doc_id, text in zip(batch["doc_id"], batch["text"]):
                    waiting.append((doc_id.as_py(), text.as_py() or ""))
                    size += len(waiting[-1][1]) + 100
                    if size >= _CHARACTERS:
                        held.add(*_aligned_batch(known, waiting))
                        waiting, size = [], 0
                    if held.size >= block:
                        yield held.record(number)
                        number, held = number + 1, _Block()
            if waiting:
                held.add(*_aligned_batch(known, waiting))
            if held.rows:
                yield held.record(number)

        for record in records():
            yield from in_batches(iter([record]), _schema(_BLOCK_SCHEMA), lambda row: 0)

    return docs.mapInArrow(run, _BLOCK_SCHEMA)


def _schema(text: str) -> pa.Schema:
    kinds = {
        "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
        "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ") for c in text.split(", "))])


def _unpacked(rows: DataFrame, key: str, last: str) -> DataFrame:
    """A row for each pair: the row's ``key``, the pair's place in it, the pair, and ``last``, which
    is stored beside the pairs."""
    schema = f"{key} long, place long, pair long, {last} long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, pairs, values in zip(batch[key], batch["pairs"], batch[last]):
                pairs = np.frombuffer(pairs.as_buffer() or b"", "<i8")
                values = np.frombuffer(values.as_buffer() or b"", "<u4").astype(np.int64)
                for at in range(0, len(pairs), _ROWS):
                    part = slice(at, at + _ROWS)
                    n = len(pairs[part])
                    columns = [np.full(n, k.as_py(), np.int64), np.arange(at, at + n), pairs[part], values[part]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_schema(schema))

    return rows.select(key, "pairs", last).mapInArrow(run, schema)


# --- Documents of several ranges --------------------------------------------------------

_RANGE_SCHEMA = "key long, doc_id long, part long, a_at long, a_text string, b_at long, b_text string"
_FOUND_SCHEMA = (
    "key long, part long, same boolean, prefix binary, suffix binary, "
    "at long, n_a long, n_b long, n_groups long, shown string, pairs binary, times binary"
)


def cut_points(text: str, size: int, before_spaces: bool) -> list[tuple[int, int]]:
    """Where each range of a text begins for a and for b, near multiples of ``size`` characters.

    a is cut before white space after another character, which is where one of its words ends
    whatever follows; b before a single space after another character, as no piece runs over that.
    A text without such places is one range.
    """
    found, at = [(0, 0)], size
    space_a, space_b = regex.compile(r"(?<=\S)\s"), regex.compile(r"(?<=[^ ▁]) (?=[^ ])")
    while before_spaces and at < len(text):
        a, b = space_a.search(text, at), space_b.search(text, at)
        if not a or not b:
            break
        if a.start() > found[-1][0] and b.start() > found[-1][1]:
            found.append((a.start(), b.start()))
        at = max(at, a.start(), b.start()) + size
    return found


def _ranges(docs: DataFrame, path_a: str, path_b: str, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizers(path_a, path_b)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for key, doc_id, text in zip(batch["key"], batch["doc_id"], batch["text"]):
                    text = text.as_py()
                    points = [*cut_points(text, size, known.cut_before_spaces), (len(text), len(text))]
                    a_at = b_at = 0
                    for part, ((a, b), (a_next, b_next)) in enumerate(zip(points, points[1:])):
                        a_text = text[a:a_next] if part else " " + text[:a_next]
                        b_text = text[b + 1 : b_next] if part else text[:b_next]
                        yield key.as_py(), doc_id.as_py(), part, a_at, a_text, b_at, b_text
                        a_at += len(a_text.encode())
                        b_at += len(b_text.encode()) + 1

        yield from in_batches(rows(), _schema(_RANGE_SCHEMA), lambda row: 2 * len(row[4]))

    return docs.mapInArrow(run, _RANGE_SCHEMA)


def _as_binary(tokens: Tokens) -> bytes:
    sizes = np.array([len(tokens.a), len(tokens.b)], "<i8")
    return b"".join([sizes.tobytes(), *(_packed(p, "<i8") for p in tokens.parts())])


def _from_binary(data: bytes) -> Tokens:
    values = np.frombuffer(data, "<i8").astype(np.int64)
    n_a, n_b = values[:2]
    return Tokens(*np.split(values[2:], np.cumsum([n_a, n_a, n_b])))


def _open_row(key: int, part: int, same: bool, f: Fragment) -> tuple:
    suffix = None if f.suffix is None else _as_binary(f.suffix)
    return key, part, same, _as_binary(f.prefix), suffix, *[None] * 7


def _closed_rows(known: Tokenizers, key: int, tokens: Tokens) -> Iterator[tuple]:
    if not len(tokens.a) or not len(tokens.b):
        return
    groups = Aligned(tokens)
    at_a, at_b = groups.links()
    pairs, times = np.unique((tokens.a[at_a] << _BITS) | tokens.b[at_b], return_counts=True)
    shown = "".join(groups.shown(known.shown, len(known.a_bytes), len(known.b_bytes)))[:-1]
    yield (
        key, None, None, None, None, int(tokens.a_ends[0]), len(tokens.a), len(tokens.b),
        int(groups.last_a.sum()), shown, _packed(pairs, "<i8"), _packed(times, "<u4"),
    )


def _row_size(row: tuple) -> int:
    return sum(len(v) for v in row if isinstance(v, (bytes, str)))


def _fragments(ranges: DataFrame, path_a: str, path_b: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizers(path_a, path_b)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for r in batch.to_pylist():
                    ids = known.ids(r["a_text"], r["b_text"], r["a_text"].encode(), b" " + r["b_text"].encode())
                    if ids is None:
                        yield _open_row(r["key"], r["part"], False, Fragment(NO_TOKENS, None))
                        continue
                    a, b = ids
                    ends_a = r["a_at"] + np.cumsum(known.a_lengths[a])
                    found, closed = fragment(Tokens(a, ends_a, b, r["b_at"] + np.cumsum(known.b_lengths[b])))
                    yield _open_row(r["key"], r["part"], True, found)
                    yield from _closed_rows(known, r["key"], closed)

        yield from in_batches(rows(), _schema(_FOUND_SCHEMA), _row_size)

    return ranges.mapInArrow(run, _FOUND_SCHEMA)


def _compose(fragments: DataFrame, path_a: str, path_b: str, last: bool) -> DataFrame:
    """Neighbours composed, ``_FAN`` at a time. In the last step a document is one fragment, whose
    open prefix begins with the text and is its first group."""

    def run(table: pa.Table) -> pa.Table:
        known = tokenizers(path_a, path_b)
        rows = sorted(table.select(["key", "part", "same", "prefix", "suffix"]).to_pylist(), key=lambda r: r["part"])
        whole, found = Fragment(NO_TOKENS, None), []
        key, same = rows[0]["key"], all(r["same"] for r in rows)
        for r in rows:
            suffix = None if r["suffix"] is None else _from_binary(r["suffix"])
            whole, closed = composed(whole, Fragment(_from_binary(r["prefix"]), suffix))
            found += _closed_rows(known, key, closed)
        if last:
            found += _closed_rows(known, key, whole.prefix if same else NO_TOKENS)
            whole = Fragment(NO_TOKENS, None)
        found.append(_open_row(key, rows[0]["part"] // _FAN, same, whole))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*found), _schema(_FOUND_SCHEMA))], schema=_schema(_FOUND_SCHEMA))

    opened = fragments.where("part is not null").select("key", "part", "same", "prefix", "suffix")
    groups = opened.withColumn("_group", F.floor(F.col("part") / _FAN)).groupBy("key", "_group")
    return groups.applyInArrow(lambda table: run(table.drop_columns("_group")), _FOUND_SCHEMA)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 for each document of several ranges, whose groups come in order."""
    pieces = ((k.as_py(), s.as_py()) for batch in batches for k, s in zip(batch["key"], batch["shown"]))
    for key, group in groupby(pieces, lambda p: p[0]):
        state = hashlib.sha256()
        for k, (_, shown) in enumerate(group):
            state.update(((";" if k else "") + shown).encode())
        yield pa.RecordBatch.from_pydict({"key": pa.array([key], pa.int64()), "digest": [state.hexdigest()]})


def _long_documents(stored: Stored, docs: DataFrame, path_a: str, path_b: str, size: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the long documents (``key``, ``doc_id``, ``n_a``, ``n_b``, ``n_groups``,
    ``digest``), and their distinct pairs (``key``, ``pair``, ``times``)."""
    ranges = stored.write(_ranges(docs.withColumn("key", F.monotonically_increasing_id()), path_a, path_b, size))
    levels = [stored.write(_fragments(ranges.repartition("key", "part").drop("doc_id"), path_a, path_b))]
    left = ranges.agg(F.coalesce(F.max("part"), F.lit(0)) + 1).first()[0]
    while True:
        levels.append(stored.write(_compose(levels[-1], path_a, path_b, left <= _FAN)))
        left = -(-left // _FAN)
        if left == 1:
            break
    same = levels[-1].where("part is not null").select("key", "same")
    closed = levels[0].where("at is not null")
    for level in levels[1:]:
        closed = closed.unionByName(level.where("at is not null"))
    closed = closed.join(same.where("same").select("key"), "key", "left_semi")
    digests = closed.select("key", "at", "shown").repartition("key").sortWithinPartitions("key", "at").mapInArrow(
        _digests, "key long, digest string"
    )
    sums = closed.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups")))
    named = ranges.where("part = 0").select("key", "doc_id")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_a", "n_b", "n_groups")]
    rows = named.join(sums, "key", "left").join(digests, "key", "left")
    rows = rows.select("key", "doc_id", *zero, F.coalesce("digest", F.lit("")).alias("digest"))
    pairs = _unpacked(closed, "key", "times").groupBy("key", "pair").agg(F.sum("times").alias("times"))
    return stored.write(rows), stored.write(pairs)


# --- All documents ----------------------------------------------------------------------

_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def aligned(docs: DataFrame, path_a: str, path_b: str, size: int = RANGE, block: int = _BLOCK) -> DataFrame:
    """The tokens of each text of ``docs`` (``doc_id``, ``text``) by two tokenizers, aligned.

    ``path_a`` is a byte-level BPE file, given a space and the text; ``path_b`` a sentencepiece
    model, which adds that space; special tokens in a text are plain text. Returns for each row
    ``doc_id``, its tokens ``n_a`` and ``n_b``, its groups between offsets where tokens of both
    end, its links (pairs of tokens that share bytes), ``n_best`` of them whose pair of ids is
    held, as a link, by the most documents among the pairs of its a id, ``count_sum`` of these
    numbers of documents over the links, and the digest of the groups' ids. A text that is null or
    empty, or that a tokenizer does not give back byte by byte, has no tokens: zeros and an empty
    digest. Rows with a null or a repeated doc_id are documents of their own.

    Texts of more than ``size`` characters are cut in ranges; fragments are composed ``_FAN`` at a
    time until a text is one. A task holds some two million characters, or a block of ``block``
    pairs of documents.
    """
    spark = docs.sparkSession
    workers_find_package(spark)
    stored = Stored(spark, "alignment")
    texts = docs.selectExpr("cast(doc_id AS long) AS doc_id", "text")
    is_long = F.coalesce(F.length("text") > size, F.lit(False))
    blocks = stored.write(_blocks(texts.where(~is_long), path_a, path_b, block))
    long_rows, long_pairs = _long_documents(stored, texts.where(is_long), path_a, path_b, size)

    of_blocks = _unpacked(blocks, "block", "holders")
    held = of_blocks.select("pair", "holders").unionByName(long_pairs.select("pair", F.lit(1).cast("long").alias("holders")))
    counts = stored.write(held.groupBy("pair").agg(F.sum("holders").alias("n")))
    first = F.shiftright("pair", _BITS).alias("_a")
    best = counts.groupBy(first).agg(F.max("n").alias("_most"))  # as many rows as a has ids
    counted = counts.withColumn("_a", first).join(best, "_a").select("pair", "n", (F.col("n") == F.col("_most")).alias("best"))
    counted = stored.write(counted)

    looked_up = of_blocks.select("block", "place", "pair").join(counted, "pair").select("block", "place", "n", "best")
    short = blocks.groupBy("block").cogroup(looked_up.groupBy("block")).applyInArrow(_looked_up, _RESULT)
    sums = long_pairs.join(counted, "pair").groupBy("key").agg(
        F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    long = long_rows.join(sums, "key", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", (F.col("n_a") + F.col("n_b") - F.col("n_groups")).alias("n_links"),
        *zero, F.col("digest").alias("groups_sha256"),
    )
    return short.unionByName(long)


def _looked_up(block: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of one block, their pairs' numbers summed."""
    if not block.num_rows:
        return _schema(_RESULT).empty_table()
    row = block.to_pylist()[0]
    place = np.frombuffer(row["place"], "<u4")
    times = np.frombuffer(row["times"], "<u4").astype(np.int64)
    n, best = np.zeros(pairs.num_rows, np.int64), np.zeros(pairs.num_rows, np.int64)
    at = pairs["place"].to_numpy()
    n[at], best[at] = pairs["n"].to_numpy(), pairs["best"].to_numpy(zero_copy_only=False)
    until = np.concatenate([[0], np.cumsum(row["n_pairs"])]).astype(np.int64)

    def summed(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values[place] * times)])
        return sums[until[1:]] - sums[until[:-1]]

    n_a, n_b, groups = (np.array(row[c], np.int64) for c in ("n_a", "n_b", "n_groups"))
    columns = [row["doc_id"], n_a, n_b, groups, n_a + n_b - groups, summed(best), summed(n), row["digest"]]
    schema = _schema(_RESULT)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
