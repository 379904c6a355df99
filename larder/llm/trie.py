"""The prefix trie of conversations, built from adaptive radix trees.

A turn is a fixed-width id, a conversation the ids of its turns one after another. Conversations
are dealt to tasks by ranges of these keys; a task builds adaptive radix trees over blocks of
neighbouring keys. Only byte depths that are whole turns are nodes of the trie. What a block
cannot finish are the paths of its first and its last key, which neighbours may share: these two
go on to the next round, as a conversation each, with what the block has found beside them.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.bpe import in_batches
from larder.llm.shared import Stored, workers_find_package

WIDTH = 16  # bytes of a turn's id
_ROWS = 1 << 16  # conversations in a block
_BYTES = 1 << 24  # bytes of keys in a block
_LEAST = 8  # conversations in a block, however long
_EMPTY = hashlib.sha256(b"").hexdigest()


# --- Adaptive radix tree ----------------------------------------------------------------


class Few:
    """Children of a node with up to 4 or up to 16 of them: labels in order, kids beside them."""

    def __init__(self, room: int):
        self.room, self.labels, self.kids = room, bytearray(), []

    def get(self, label: int):
        k = self.labels.find(label)
        return None if k < 0 else self.kids[k]

    def put(self, label: int, kid) -> bool:
        """Set a child; False if there is no room for it."""
        k = self.labels.find(label)
        if k >= 0:
            self.kids[k] = kid
            return True
        if len(self.kids) == self.room:
            return False
        k = bisect(self.labels, label)
        self.labels.insert(k, label)
        self.kids.insert(k, kid)
        return True

    def items(self):
        return zip(self.labels, self.kids)

    def larger(self):
        return Few(16) if self.room == 4 else Indexed()


class Indexed:
    """Up to 48 children: a byte for each label says where its kid is."""

    def __init__(self):
        self.places, self.kids = bytearray(256), []

    def get(self, label: int):
        place = self.places[label]
        return self.kids[place - 1] if place else None

    def put(self, label: int, kid) -> bool:
        place = self.places[label]
        if place:
            self.kids[place - 1] = kid
            return True
        if len(self.kids) == 48:
            return False
        self.kids.append(kid)
        self.places[label] = len(self.kids)
        return True

    def items(self):
        return ((label, self.kids[place - 1]) for label, place in enumerate(self.places) if place)

    def larger(self):
        return Full()


class Full:
    """A place for each label."""

    def __init__(self):
        self.kids = [None] * 256

    def get(self, label: int):
        return self.kids[label]

    def put(self, label: int, kid) -> bool:
        self.kids[label] = kid
        return True

    def items(self):
        return ((label, kid) for label, kid in enumerate(self.kids) if kid is not None)


class Node:
    """A branching point or the end of a key, with the compressed path that leads to it.

    ``edge`` is that path, from byte ``start`` of the key. ``words`` are those of any key through
    the node; ``marks`` holds what is known at the turn-aligned depths on the edge.
    """

    __slots__ = ("edge", "start", "words", "marks", "below")

    def __init__(self, edge: bytes, start: int, words):
        self.edge, self.start, self.words = edge, start, words
        self.marks: dict[int, Mark] = {}
        self.below = Few(4)

    @property
    def end(self) -> int:
        return self.start + len(self.edge)

    def add(self, label: int, kid: Node) -> None:
        while not self.below.put(label, kid):
            larger = self.below.larger()
            for known, other in self.below.items():
                larger.put(known, other)
            self.below = larger


class Mark:
    """What is known at a node of the trie beside what its tree holds below it: conversations that
    end here or in subtrees finished earlier, the smallest of them, and for the finished subtrees
    their number, leaves and saved tokens."""

    __slots__ = ("n", "low", "kids", "leaves", "saved", "ids")

    def __init__(self, n=0, low=None, kids=0, leaves=0, saved=0, ids=None):
        self.n, self.low, self.kids, self.leaves, self.saved, self.ids = n, low, kids, leaves, saved, ids

    def add(self, other: Mark) -> None:
        self.n += other.n
        self.low = _least(self.low, other.low)
        self.kids += other.kids
        self.leaves += other.leaves
        self.saved += other.saved
        if other.ids:
            self.ids = (self.ids or array("q")) + other.ids


def _least(a, b):
    return a if b is None else b if a is None else min(a, b)


class Tree:
    """Adaptive radix tree over keys of whole turns; a key may be the beginning of another."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.root = Node(b"", 0, ())

    def put(self, key: bytes, words, marks: dict[int, Mark]) -> None:
        """Add a key and what is known at its depths."""
        nodes = self._reach(key, words)
        for depth, mark in marks.items():
            at = next(n for n in reversed(nodes) if n.start < depth * self.width or not n.edge)
            if depth in at.marks:
                at.marks[depth].add(mark)
            else:
                at.marks[depth] = mark

    def _reach(self, key: bytes, words) -> list[Node]:
        """The nodes on the path of a key, which is added where it is not there yet."""
        node, nodes, at = self.root, [], 0
        while True:
            if not key.startswith(node.edge, at):
                node = self._split(nodes[-1], node, key)
            nodes.append(node)
            at = node.end
            if at == len(key):
                return nodes
            kid = node.below.get(key[at])
            if kid is None:
                kid = Node(key[at:], at, words)
                node.add(key[at], kid)
            node = kid

    def _split(self, above: Node, node: Node, key: bytes) -> Node:
        rest = key[node.start : node.end]
        same = next((k for k, (a, b) in enumerate(zip(node.edge, rest)) if a != b), len(rest))
        upper = Node(node.edge[:same], node.start, node.words)
        node.edge, node.start = node.edge[same:], node.start + same
        for depth in [d for d in node.marks if d * self.width <= node.start]:
            upper.marks[depth] = node.marks.pop(depth)
        upper.add(node.edge[0], node)
        above.add(upper.edge[0], upper)
        return upper

    def path(self, key: bytes) -> list[Node]:
        return self._reach(key, ())


class _Below:
    """Sums over finished subtrees, and the rows of their top nodes, which wait for a parent."""

    __slots__ = ("n", "low", "tops", "leaves", "saved")

    def __init__(self):
        self.n, self.low, self.tops, self.leaves, self.saved = 0, None, [], 0, 0

    def add(self, other: _Below) -> None:
        self.n += other.n
        self.low = _least(self.low, other.low)
        self.tops += other.tops
        self.leaves += other.leaves
        self.saved += other.saved


# --- One block --------------------------------------------------------------------------

_NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
_FOUND = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, parent_ref binary, ref binary, "
    "path binary, words array<int>, n array<long>, low array<long>, kids array<long>, leaves array<long>, saved array<long>, "
    "piece_of binary, piece_at long, piece string"
)
_PATH = ("n", "low", "kids", "leaves", "saved")


def _arrow() -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ") for c in _FOUND.split(", "))])


def _references(key: bytes, width: int) -> list[bytes]:
    """A digest of each beginning of a key, by its depth."""
    state, found = hashlib.sha256(), []
    for at in range(0, len(key) + 1, width):
        found.append(state.copy().digest()[:16])
        state.update(key[at : at + width])
    return found


def _nodes_of_block(tree: Tree, first: tuple, last: tuple, whole: bool, named: bool) -> Iterator[dict]:
    """The finished nodes of a block, and the paths of its first and last key unless it is the
    ``whole``. ``named``: its nodes were on such paths before and are known by digests."""
    width = tree.width
    paths = [] if whole else [first] if first[0] == last[0] else [first, last]
    open_at: dict[int, int] = {}
    for k, (key, _) in enumerate(paths):
        for node in tree.path(key):
            open_at.setdefault(id(node), k)
    references = [_references(key, width) for key, _ in paths]
    known = [[Mark() for _ in range(len(key) // width + 1)] for key, _ in paths]

    order = [tree.root]
    for node in order:
        order.extend(kid for _, kid in node.below.items())
    names = _names(tree, order) if named else {}
    done: dict[int, _Below] = {}
    for node in reversed(order):
        below = _Below()
        for _, kid in node.below.items():
            below.add(done.pop(id(kid)))
        highest = -1 if node is tree.root else node.start // width
        for depth in range(node.end // width, highest, -1):
            mark = node.marks.get(depth) or Mark()
            n, low = below.n + mark.n, _least(below.low, mark.low)
            kids, leaves, saved = len(below.tops) + mark.kids, below.leaves + mark.leaves, below.saved + mark.saved
            if id(node) in open_at:
                which = open_at[id(node)]
                for row in below.tops:
                    yield row | {"parent_ref": references[which][depth]}
                known[which][depth] = Mark(n, low, kids, leaves, saved)
                if mark.ids:
                    yield {"piece_of": references[which][depth], "piece_at": mark.ids[0], "piece": ",".join(map(str, mark.ids))}
                below = _Below()
                continue
            for row in below.tops:
                yield row | {"parent_conv_id": low}
            leaves = leaves if kids else 1
            saved += (n - 1) * node.words[depth - 1] if depth else 0
            ends = hashlib.sha256(",".join(map(str, mark.ids)).encode()).hexdigest() if mark.ids else _EMPTY
            row = {"conv_id": low, "depth": depth, "n_convs": n, "n_children": kids, "n_leaves": leaves, "saved_tokens": saved}
            row |= {"ref": names[id(node)][depth]} if named else {"ends_sha256": ends}
            below = _Below()
            below.n, below.low, below.tops, below.leaves, below.saved = n, low, [row], leaves, saved
        done[id(node)] = below
    yield from done[id(tree.root)].tops
    for (key, words), marks in zip(paths, known):
        yield {"path": key, "words": words} | {name: [getattr(m, name) for m in marks] for name in _PATH}


def _names(tree: Tree, order: list[Node]) -> dict[int, dict[int, bytes]]:
    """The digests of the turn-aligned depths on every node's edge."""
    states = {id(tree.root): hashlib.sha256()}
    names = {id(tree.root): {0: states[id(tree.root)].digest()[:16]}}
    for node in order:
        for _, kid in node.below.items():
            state, at = states[id(node)].copy(), kid.start
            names[id(kid)] = {}
            while at < kid.end:
                step = min(tree.width - at % tree.width, kid.end - at)
                state.update(kid.edge[at - kid.start : at - kid.start + step])
                at += step
                if at % tree.width == 0:
                    names[id(kid)][at // tree.width] = state.copy().digest()[:16]
            states[id(kid)] = state
    return names


def _blocks(rows: Iterator[tuple], whole: bool, named: bool, most_rows: int, width: int) -> Iterator[dict]:
    """``rows`` in the order of their keys: key, words, marks by depth."""
    tree, first, last, n, size = None, None, None, 0, 0
    for key, words, marks in rows:
        if tree is None:
            tree, first, n, size = Tree(width), (key, words), 0, 0
        tree.put(key, words, marks)
        last = (key, words)
        n += 1
        size += len(key)
        if not whole and n >= _LEAST and (n >= most_rows or size >= _BYTES):
            yield from _nodes_of_block(tree, first, last, False, named)
            tree = None
    if tree is not None:
        yield from _nodes_of_block(tree, first, last, whole, named)


def _of_conversations(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    for batch in batches:
        for key, conv_id, words in zip(batch["key"], batch["conv_id"], batch["words"]):
            key, conv_id = key.as_py(), conv_id.as_py()
            yield key, words.as_py(), {len(key) // width: Mark(1, conv_id, ids=array("q", [conv_id]))}


def _of_paths(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    for batch in batches:
        for row in batch.to_pylist():
            marks = {d: Mark(*known) for d, known in enumerate(zip(*(row[name] for name in _PATH)))}
            yield row["path"], row["words"], marks


# --- On Spark ---------------------------------------------------------------------------


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id`` with the ``ids`` (hex) and ``words`` of its turns, from rows of ``conv_id``,
    ``turn``, ``role`` and ``text``.

    Turns are ordered by ``turn``, null first; of equal ones the digest of role and text decides.
    A null role or text is empty; rows without a conv_id are left out; repeated rows are turns of
    their own. Texts stay where they are: 16 bytes of their SHA-256 and a count of words go on. A
    conversation is one row, so its turns (some 60 bytes each) must fit a task.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.substring(digest, 1, 2 * WIDTH).alias("id"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
        ).alias("t"),
    )
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.col("t.id").alias("ids"), F.col("t.words").alias("words"))


def with_shared_openings(found: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """``sequences`` in which conversation c begins like conversation c - c % ``every``: its first
    h turns are the other's (all if it has fewer, none if it is absent), h = crc32(c) % ``most``,
    c in decimal."""
    stored = Stored(found.sparkSession, "openings")
    found = stored.write(found)
    heads = found.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("_base"),
        F.slice("ids", 1, most - 1).alias("_ids"), F.slice("words", 1, most - 1).alias("_words"),
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    joined = found.withColumn("_h", h).join(
        heads, F.col("conv_id") - F.col("conv_id") % every == F.col("_base"), "left"
    )

    def rebuilt(name: str):
        head = F.when(F.col(f"_{name}").isNull(), F.slice(name, 1, 0)).otherwise(F.slice(f"_{name}", F.lit(1), F.col("_h")))
        return F.concat(head, F.slice(name, F.col("_h") + 1, F.greatest(F.size(name), F.lit(1)))).alias(name)

    return joined.select("conv_id", rebuilt("ids"), rebuilt("words"))


def prefix_nodes(found: DataFrame, most_rows: int = _ROWS) -> DataFrame:
    """The nodes of the prefix trie of ``sequences`` (``conv_id``, ``ids``, ``words``).

    One row for each distinct beginning of d turns, the root (d = 0) included: ``conv_id`` is its
    smallest conversation, ``depth`` d, ``parent_conv_id`` the parent's ``conv_id``, ``n_convs``
    the conversations that begin with it, ``n_children`` and ``n_leaves`` its children and the
    childless nodes of its subtree, ``saved_tokens`` the sum over the subtree of each node's
    ``n_convs`` - 1 times the words of its last turn, ``ends_sha256`` the SHA-256 of the conv_ids
    that end there, ascending and joined by commas. No conversations, no rows. Conversations
    without turns end at the root; copies of one another end at one node. Rows of one conv_id are
    conversations of their own.

    Keys are sorted and dealt by range together with conv_ids, so a hot opening or a group of
    copies is spread over tasks; a task holds a block of at most ``most_rows`` conversations. Each
    round leaves two paths to a block. Numbers of conversations that end at a path's node are
    kept as texts of a block each and hashed in a stream.
    """
    spark = found.sparkSession
    workers_find_package(spark)
    stored = Stored(spark, "trie")
    keyed = found.select("conv_id", F.unhex(F.array_join("ids", "")).alias("key"), "words")
    rows = stored.write(keyed).repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    read, named, rounds = _of_conversations, False, []
    while True:
        result = stored.write(_round(rows, read, False, named, most_rows))
        rounds.append(result)
        paths = result.where("path is not null").select("path", "words", *_PATH)
        left = paths.agg(F.count("*").alias("n"), F.sum(F.length("path")).alias("size")).first()
        read, named = _of_paths, True
        if not left["n"]:
            break
        if left["n"] <= max(most_rows, _LEAST) and left["size"] <= 4 * _BYTES or left["n"] <= 2 * _LEAST:
            # The paths fit one block, the last: nothing is left open.
            last = paths.coalesce(1).sortWithinPartitions("path")
            rounds.append(stored.write(_round(last, read, True, True, most_rows)))
            break
        # Parts of many paths each, so that fewer are left every time.
        parts = min(left["n"] // (2 * _LEAST), max(left["n"] // most_rows, left["size"] // _BYTES) + 1)
        rows = paths.repartitionByRange(max(1, parts), "path").sortWithinPartitions("path")
    return _assembled(stored, rounds)


def _round(rows: DataFrame, read, whole: bool, named: bool, most_rows: int) -> DataFrame:
    schema = _arrow()
    names = schema.names
    words = names.index("words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _blocks(read(batches, WIDTH), whole, named, most_rows, WIDTH)
        tuples = (tuple(map(row.get, names)) for row in found)
        yield from in_batches(tuples, schema, lambda row: 200 + len(row[-1] or "") + 56 * len(row[words] or ()))

    return rows.mapInArrow(run, _FOUND)


def _assembled(stored: Stored, rounds: list[DataFrame]) -> DataFrame:
    nodes = rounds[0].where("depth is not null")
    for later in rounds[1:]:
        nodes = nodes.unionByName(later.where("depth is not null"))
    pieces = rounds[0].where("piece_of is not null").select("piece_of", "piece_at", "piece")
    ends = pieces.repartition("piece_of").sortWithinPartitions("piece_of", "piece_at").mapInArrow(
        _digests, "_of binary, _ends string"
    )
    # Nodes that were on a path of a block: few, and known by digests.
    shared = nodes.where("ref is not null").drop("ends_sha256").join(ends, F.col("ref") == F.col("_of"), "left")
    shared = stored.write(shared.withColumn("ends_sha256", F.coalesce("_ends", F.lit(_EMPTY))).drop("_of", "_ends"))
    own = rounds[0].where("depth is not null")
    every = own.select(*_NODE, "parent_ref").unionByName(shared.select(*_NODE, "parent_ref"))
    parents = shared.select(F.col("ref").alias("_ref"), F.col("conv_id").alias("_parent"))
    settled = every.where("parent_ref is null").select(*_NODE)
    waiting = every.where("parent_ref is not null").join(parents, F.col("parent_ref") == F.col("_ref"))
    return settled.unionByName(waiting.withColumn("parent_conv_id", F.col("_parent")).select(*_NODE))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 for each run of pieces, which come in order."""
    pieces = (
        (of.as_py(), piece.as_py()) for batch in batches for of, piece in zip(batch["piece_of"], batch["piece"])
    )
    for of, group in groupby(pieces, lambda p: p[0]):
        state = hashlib.sha256()
        for k, (_, piece) in enumerate(group):
            state.update((("," if k else "") + piece).encode())
        yield pa.RecordBatch.from_pydict({"_of": pa.array([of], pa.binary()), "_ends": [state.hexdigest()]})
