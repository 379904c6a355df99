"""Byte-pair encoding as a streaming transducer, and decoding as a state machine.

Text goes in piece by piece; an id comes out as soon as no text that may follow can change it, so
what is held does not grow with the text. How long that takes follows from the merge list alone:
its sufficient lookahead is the largest number of bytes over which a difference in what follows
can travel to the left (``Vocabulary.lookahead``).
"""

from __future__ import annotations

import bisect
import codecs
import json
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from larder.llm.shared import workers_find_package

# The words into which byte-level vocabularies split text, and the runs in them.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RUNS = (r"\p{L}*", r"\p{N}*", r"\s*", r"[^\s\p{L}\p{N}]*")

_SEEN = 3  # characters from its start that decide how a word begins ('re, 've, 'll)
_CHUNK = 1 << 16  # characters fed at once
_CACHED = 1 << 18  # words whose ids a worker remembers, twice
_OUT = 1 << 22  # bytes of results in a batch
_NEVER = 1 << 62


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes stand for
    themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes beyond the end of a token that decide whether it stays, whatever follows them.

    Take one text with two continuations and merge both in the order of the list. Where they first
    differ moves to the left only when a merge (u, v) happens in one of them, u being the last
    token they share. The next such merge comes later in the list and its right part is a token
    that grew from u, which then began at the difference. So the way to the left is a chain of
    merges, later and later, each one's right part with the left part of the one before at the
    start of its derivation, and as long as all their left parts. The longest chain is found in
    one pass over the list. Merges must be proper: both parts are single bytes or made earlier,
    and each token is made by one merge.
    """
    made = {bytes([b]): -1 for b in range(256)}
    first_part: dict[bytes, bytes] = {}
    reach: dict[bytes, tuple[list[int], list[int]]] = {}  # left part: ranks, longest chain so far

    def before(token: bytes, rank: int) -> int:
        ranks, longest = reach.get(token, ((), ()))
        k = bisect.bisect_right(ranks, rank)
        return longest[k - 1] if k else 0

    most = 0
    for rank, (u, v) in enumerate(merges):
        if u not in made or v not in made or u + v in made:
            raise ValueError(f"merge {rank} is not proper: {u!r} {v!r}")
        length, token = before(v, rank - 1), v
        while token in first_part:
            length = max(length, before(first_part[token], made[token]))
            token = first_part[token]
        length += len(u)
        made[u + v], first_part[u + v] = rank, u
        ranks, longest = reach.setdefault(u, ([], []))
        ranks.append(rank)
        longest.append(max(length, longest[-1] if longest else 0))
        most = max(most, length)
    return most


class _Remembered(dict):
    """Ids of words; full, it starts afresh but can still look into what it held."""

    def __init__(self, encode):
        self.encode = encode
        self.older: dict = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.older.pop(word, None) or tuple(self.encode(word.encode()))
        if len(word) <= 64:
            if len(self) >= _CACHED:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Vocabulary:
    """A byte-level tokenizer file: its merge list, its added tokens and its lookahead."""

    def __init__(self, path: str, special_as_text: bool = False):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splitter = spec["model"], spec.get("pre_tokenizer") or {}
        byte_level = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True)
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or not byte_level or splitter.get("add_prefix_space") or odd or spec.get("normalizer"):
            raise ValueError(f"{path} is no plain byte-level BPE file")
        letters = byte_letters()

        def as_bytes(token: str) -> bytes:
            return bytes(map(letters.__getitem__, token))

        def as_shown(token: str) -> bytes:
            return as_bytes(token) if set(token) <= letters.keys() else token.encode()

        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merges = [(as_bytes(u), as_bytes(v)) for u, v in pairs]
        self.lookahead = sufficient_lookahead(merges)
        added = spec.get("added_tokens") or []
        if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path} has added tokens that take in what stands around them")
        self.added = {t["content"]: t["id"] for t in added if not (special_as_text and t["special"])}
        ids = {as_bytes(t): i for t, i in model["vocab"].items() if set(t) <= letters.keys()}
        self.bytes_of = {i: as_shown(t) for t, i in model["vocab"].items()} | {t["id"]: as_shown(t["content"]) for t in added}
        self.single = [ids[bytes([b])] for b in range(256)]
        self.ranks = {(ids[u], ids[v]): rank for rank, (u, v) in enumerate(merges)}
        self.made = [ids[u + v] for u, v in merges]
        longest = max((len(u) + len(v) for u, v in merges), default=1)
        self.window = 2 * (self.lookahead + longest) + 1
        self.words = regex.compile(WORDS)
        self.runs = [regex.compile(r) for r in RUNS]
        # Longer added tokens first: of several at one place the longest counts.
        self.added_at = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.remembered = _Remembered(self.merged)

    def merged(self, data: bytes) -> list[int]:
        """The ids of bytes that are one word, by the merge list: first rank first, then leftmost."""
        parts = [self.single[b] for b in data]
        rank_of, made = self.ranks.get, self.made
        ranks = [rank_of(pair, _NEVER) for pair in zip(parts, parts[1:])]
        while ranks and (rank := min(ranks)) != _NEVER:
            k = ranks.index(rank)
            parts[k] = token = made[rank]
            del parts[k + 1], ranks[k]
            if k:
                ranks[k - 1] = rank_of((parts[k - 1], token), _NEVER)
            if k < len(ranks):
                ranks[k] = rank_of((token, parts[k + 1]), _NEVER)
        return parts

    def encode(self, chunks: Iterable[str]) -> Iterator[array]:
        """The ids of a text that comes in chunks, a few at a time and each as soon as it is sure."""
        held, part = "", _Part(self)
        for chunk in chunks:
            held += chunk
            while self.added_at and (found := self.added_at.search(held)):
                rest = held[found.start() :]
                if any(t.startswith(rest) and t != rest for t in self.added):
                    break  # a longer one may still come
                yield part.feed(held[: found.start()])
                yield part.finish()
                yield array("I", [self.added[found.group()]])
                held = held[found.end() :]
            sure = len(held) - self._start_of_added(held)
            yield part.feed(held[:sure])
            held = held[sure:]
        while self.added_at and (found := self.added_at.search(held)):
            yield part.feed(held[: found.start()])
            yield part.finish()
            yield array("I", [self.added[found.group()]])
            held = held[found.end() :]
        yield part.feed(held)
        yield part.finish()

    def _start_of_added(self, text: str) -> int:
        """Characters at the end of ``text`` that may begin an added token."""
        longest = max(map(len, self.added), default=0)
        for size in range(min(longest, len(text)), 0, -1):
            if any(t.startswith(text[-size:]) for t in self.added):
                return size
        return 0

    def ids(self, text: str) -> array:
        out = array("I")
        for piece in self.encode(text[k : k + _CHUNK] for k in range(0, len(text), _CHUNK)):
            out += piece
        return out


class _Part:
    """Text between added tokens: words, and the bytes of a word that is longer than the window.

    ``tail`` holds the characters that are in no sure word yet. Once they are more than the window,
    they are a run of one kind of character; its bytes go through a window of ``Vocabulary.window``
    bytes, of which the tokens that end ``lookahead`` bytes before its end are sure.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.tail = ""
        self.run = None  # the pattern of the run that is open
        self.data = bytearray()

    def _spaces(self) -> bool:
        return self.run is self.vocabulary.runs[2]

    def _words(self, words: list[str]) -> array:
        return array("I", chain.from_iterable(map(self.vocabulary.remembered.__getitem__, words)))

    def _through_window(self, text: str, end: bool) -> array:
        v, ids = self.vocabulary, array("I")
        self.data += text.encode()
        done = 0
        while len(self.data) - done >= v.window:
            found = v.merged(self.data[done : done + v.window])
            sure = done + v.window - v.lookahead
            for i in found:
                stop = done + len(v.bytes_of[i])
                if stop > sure:
                    break
                ids.append(i)
                done = stop
        del self.data[:done]
        if end:
            ids.extend(v.merged(bytes(self.data)))
            self.data.clear()
            self.run = None
        return ids

    def feed(self, text: str) -> array:
        v, ids = self.vocabulary, array("I")
        text = self.tail + text
        if self.run:
            end = self.run.match(text).end()
            # The last space of a run before a word is the word's own, so one is always held.
            own = end - 1 if self._spaces() and end else end
            ids += self._through_window(text[:own], end < len(text))
            if self.run:
                self.tail = text[own:]
                return ids
            text = text[own:]
        words = v.words.findall(text)
        left = 0
        while words and (not left or left + len(words[-1]) < _SEEN):
            left += len(words.pop())
        ids += self._words(words)
        self.tail = text[len(text) - left :]
        if left > v.window:
            self.run = next(r for r in v.runs if r.match(self.tail[-1]).end())
            own = left - 1 if self._spaces() else left
            ids += self._through_window(self.tail[:own], False)
            self.tail = self.tail[own:]
        return ids

    def finish(self) -> array:
        """Nothing follows: what is left is sure."""
        text, self.tail = self.tail, ""
        if self.run:
            return self._through_window(text, True)
        return self._words(self.vocabulary.words.findall(text))


class Decoding:
    """Ids to text, a few at a time: bytes of a character that is not complete yet are held. Bytes
    that are no UTF-8 become U+FFFD; ids that the file lacks are passed over."""

    def __init__(self, vocabulary: Vocabulary):
        self.bytes_of = vocabulary.bytes_of
        self.states = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.states.decode(b"".join([self.bytes_of.get(i, b"") for i in ids]))

    def finish(self) -> str:
        return self.states.decode(b"", final=True)


@lru_cache(maxsize=4)
def vocabulary(path: str, special_as_text: bool = False) -> Vocabulary:
    return Vocabulary(path, special_as_text)


def in_batches(rows: Iterator[tuple], schema: pa.Schema, size_of) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a few megabytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row) + 64
        if size >= _OUT:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def encoded(docs: DataFrame, tokenizer: str, special_as_text: bool = False) -> DataFrame:
    """``doc_id`` and ``ids`` of every row of ``docs`` (``doc_id``, ``text``): the ids that the
    tokenizer file gives, as little-endian 32-bit numbers.

    Strings of added tokens in a text become their ids; with ``special_as_text`` those of special
    ones are plain text. A null or empty text has no ids. Rows with a null or a repeated doc_id are
    encoded like others; further columns are left out. Nothing is shuffled. A text of any length
    goes through in chunks, beside which a task holds a window of bytes and the ids of the
    text; files that are no plain byte-level BPE are refused.
    """
    workers_find_package(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(tokenizer, special_as_text)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, text in zip(batch["doc_id"], batch["text"]):
                    ids = known.ids(text.as_py() or "")
                    yield doc_id.as_py(), little_endian(ids)

        yield from in_batches(rows(), schema, lambda row: len(row[1]))

    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def decoded(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``rows`` of ``encoded`` (``doc_id``, ``ids``) with their ``text``, special tokens included.

    A null ``ids`` counts as empty. Ids are read in chunks; characters cut by a chunk's end are
    put together by the state machine.
    """
    workers_find_package(rows.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(tokenizer)

        def found() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, data in zip(batch["doc_id"], batch["ids"]):
                    data = data.as_py() or b""
                    states = Decoding(known)
                    text = [states.feed(from_little_endian(data[k : k + _CHUNK])) for k in range(0, len(data), _CHUNK)]
                    yield doc_id.as_py(), data, "".join([*text, states.finish()])

        yield from in_batches(found(), schema, lambda row: 2 * len(row[1]))

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` and ``decoded`` in one pass: ``doc_id``, ``ids`` and the ``text`` they give back.

    Every id goes from the encoder to the decoder as soon as it is sure.
    """
    workers_find_package(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(tokenizer)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, text in zip(batch["doc_id"], batch["text"]):
                    text, ids, states, back = text.as_py() or "", array("I"), Decoding(known), []
                    for piece in known.encode(text[k : k + _CHUNK] for k in range(0, len(text), _CHUNK)):
                        ids += piece
                        back.append(states.feed(piece))
                    yield doc_id.as_py(), little_endian(ids), "".join([*back, states.finish()])

        yield from in_batches(rows(), schema, lambda row: 2 * len(row[1]))

    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "text").mapInArrow(run, "doc_id long, ids binary, text string")


def little_endian(ids: array) -> bytes:
    import sys

    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def from_little_endian(data: bytes) -> array:
    import sys

    ids = array("I")
    ids.frombytes(data)
    if sys.byteorder == "big":
        ids.byteswap()
    return ids
