"""Documents packed into token sequences by the sum-of-squares rule.

Each task packs the documents of its partition in order as they come. A document goes where the
sum of the squares of the counts of partially filled windows grows least; the counts, one for
each fill, are an array of levels. What is left open at the end is cut and laid end to end.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from larder.llm.bpe import byte_letters
from larder.llm.shared import workers_find_package

CAPACITY = 1024
_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long"
)
_ROWS = 8192  # pieces in a batch of results
_TASK_BITS = 40  # sequence ids: the partition's number above, a count below


@lru_cache(maxsize=4)
def encoder(path: str, special_as_text: bool = False):
    """A function from text to the ids that the tokenizer file at ``path`` gives.

    The file's byte-level vocabulary is run by tiktoken, which is five times as fast as the
    library the file is made for and gives the same ids; a text that it refuses is left to that
    library. Strings of added tokens in a text become their ids, as the library has it; with
    ``special_as_text`` those of special tokens are ordinary text.
    """
    import json

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    plain.no_truncation()
    plain.no_padding()
    plain.encode_special_tokens = special_as_text
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {t["content"] for t in spec["added_tokens"] if t["special"]}
    added = [t["content"] for t in spec["added_tokens"] if not (special_as_text and t["special"])]
    letters = byte_letters()
    ranks = {
        bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special
    }
    fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if any(token in text for token in added):
            return plain.encode(text, add_special_tokens=False).ids
        try:
            return fast.encode_ordinary(text)
        except BaseException as error:  # noqa: BLE001  its panics are no Exceptions
            if isinstance(error, KeyboardInterrupt | SystemExit):
                raise
            return plain.encode(text, add_special_tokens=False).ids

    return encode


class Packer:
    """Windows of ``capacity`` ids, filled online.

    ``levels[f]`` is the number of open windows filled to ``f``. ``add`` returns the pieces of
    windows that are done as (sequence, offset, doc_id, start, ids, doc_tokens).
    """

    def __init__(self, capacity: int = CAPACITY, most_open: int = 4096):
        self.capacity = capacity
        self.most_open = most_open
        self.levels = np.zeros(capacity + 1, np.int64)
        self.windows: dict[int, deque] = {}
        self.n_open = 0
        self.next_sequence = 0

    def _sequence(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, ids, total in pieces:
            yield self.next_sequence, offset, doc_id, start, ids, total
            offset += len(ids)
        self.next_sequence += 1

    def level_for(self, size: int) -> int:
        """The fill, 0 for a new window, at which a piece adds least to the sum of squares; of
        equal ones the fullest."""
        levels, top = self.levels, self.capacity - size
        gain = levels[size:].copy()  # from fill f to f + size: 2 (n[f + size] - n[f]) + 2
        gain[top] = 0  # a full window is no longer open
        cost = 2 * (gain - levels[: top + 1]) + 2
        cost[top] -= 1
        cost[0] = 2 * levels[size] + 1 if top else 0
        usable = levels[: top + 1] > 0
        usable[0] = True
        cost = np.where(usable, cost, np.iinfo(np.int64).max)
        return top - int(np.argmin(cost[::-1]))

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        total = len(ids)
        whole = total - total % self.capacity
        for start in range(0, whole, self.capacity):
            yield from self._sequence([(doc_id, start, ids[start : start + self.capacity], total)])
        if whole == total:
            return
        piece = (doc_id, whole, ids[whole:], total)
        size = total - whole
        fill = self.level_for(size)
        if fill:
            window = self.windows[fill].popleft()
            self.levels[fill] -= 1
            self.n_open -= 1
        else:
            window = []
        window.append(piece)
        if fill + size == self.capacity:
            yield from self._sequence(window)
            return
        self.windows.setdefault(fill + size, deque()).append(window)
        self.levels[fill + size] += 1
        self.n_open += 1
        if self.n_open > self.most_open:
            yield from self.settle()

    def settle(self) -> Iterator[tuple]:
        """Close all open windows: those filled to a power of two as they are, the others cut
        and laid end to end in full windows, the rest in windows of powers of two."""
        loose: list[tuple] = []
        for fill in sorted(self.windows, reverse=True):
            for window in self.windows[fill]:
                if fill & (fill - 1) == 0:
                    yield from self._sequence(window)
                else:
                    loose += window
        self.windows, self.n_open = {}, 0
        self.levels[:] = 0
        left = sum(len(p[2]) for p in loose)
        pieces = iter(loose)
        piece, used = next(pieces, None), 0
        while left:
            room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
            left -= room
            window = []
            while room:
                doc_id, start, ids, total = piece
                taken = min(room, len(ids) - used)
                window.append((doc_id, start + used, ids[used : used + taken], total))
                used += taken
                room -= taken
                if used == len(ids):
                    piece, used = next(pieces, None), 0
            yield from self._sequence(window)


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, most_open: int = 4096) -> DataFrame:
    """Every token of ``docs`` (``doc_id``, ``text``) in exactly one piece of one sequence.

    A document is its ids by the tokenizer file, then ``end_id``; a null or empty text is that
    one id. Returns a row for each piece: ``doc_id``, ``start`` and ``length`` in the document,
    ``ids_crc32`` of its ids as little-endian 32-bit numbers, ``doc_tokens``, ``sequence_id`` and
    ``offset`` there. No sequence needs padding: all are full or filled to a power of two. Rows
    with a null or a repeated doc_id are documents of their own. No row is shuffled; a task holds
    one batch and at most ``most_open`` open windows, and when run again gives the same pieces.
    """
    workers_find_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        packer = Packer(capacity, most_open)
        base = TaskContext.get().partitionId() << _TASK_BITS
        rows: list[tuple] = []

        def pieces() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, text in zip(batch["doc_id"], batch["text"]):
                    ids = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                    yield from packer.add(doc_id.as_py(), ids)
            yield from packer.settle()

        for sequence, offset, doc_id, start, ids, total in pieces():
            rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, base + sequence, offset))
            if len(rows) == _ROWS:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    return docs.select("doc_id", "text").mapInArrow(run, _SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
