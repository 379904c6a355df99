"""The trie against sets of beginnings, in one block and in many."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from larder.llm import trie
from tests.llm.data import prose

ROWS = "conv_id long, turn long, role string, text string"


def brute_force(convs):
    """Rows of the trie of {conv_id: [(role, text), ...]} by every beginning of every conversation."""
    members, ends = {}, {}
    for c, turns in convs:
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    nodes = {}
    for node, held in members.items():
        kids = [k for k in members if len(k) == len(node) + 1 and k[: len(node)] == node]
        nodes[node] = [min(held), len(node), min(members[node[:-1]]) if node else None, len(held), len(kids)]
    found = []
    for node, row in nodes.items():
        below = [k for k in nodes if k[: len(node)] == node]
        leaves = sum(nodes[k][4] == 0 for k in below)
        saved = sum((nodes[k][3] - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) for k in below if k)
        names = ",".join(map(str, sorted(ends.get(node, []))))
        found.append((*row, leaves, saved, hashlib.sha256(names.encode()).hexdigest()))
    return sorted(found, key=str)


def by_turn(rows):
    """{conv_id: turns} of rows; null turns first, ties by the digest of role and text."""
    def place(row):
        turn, role, text = row[1:]
        digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()[:32]
        return turn is not None, turn or 0, digest

    convs = {}
    for c in sorted({r[0] for r in rows if r[0] is not None}):
        convs[c] = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=place)]
    return convs


def rebuilt(convs):
    found = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        found[c] = convs.get(base, [])[:h] + own[h:]
    return found


def rows_of(df):
    names = [c.split(" ")[0] for c in trie._FOUND.split(", ")][:8]
    order = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(df.columns) == sorted(names)
    return sorted(map(tuple, df.select(*order).collect()), key=str)


def random_rows(seed, n, kinds=4, most=6):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-30, 400), n):
        for t in range(draw.randint(0, most)):
            text = draw.choice(["", "a b", " c  d e ", "x", None][:kinds] if t else ["hello there", "hi"])
            rows.append((c, draw.choice([t, t, t, None]), draw.choice(["user", None]), text))
    return rows


@pytest.mark.parametrize(("seed", "most_rows"), [(1, 1 << 16), (2, 8), (3, 8), (4, 20)])
def test_nodes_equal_brute_force(spark, seed, most_rows):
    rows = random_rows(seed, 120)
    df = spark.createDataFrame(rows + [(None, 0, "user", "lost")], ROWS)
    found = trie.prefix_nodes(trie.sequences(df), most_rows)
    assert rows_of(found) == brute_force(by_turn(rows).items())


def test_shared_openings(spark):
    rows = random_rows(5, 200)
    found = trie.prefix_nodes(trie.with_shared_openings(trie.sequences(spark.createDataFrame(rows, ROWS))), 8)
    assert rows_of(found) == brute_force(rebuilt(by_turn(rows)).items())


def test_copies_repeated_rows_and_long_conversations(spark):
    """A group of copies over many blocks, a conversation with 500 turns, another that shares 300 of
    them, a very long text, repeated rows and clashing columns."""
    long = [(7000, t, "user", f"turn {t}") for t in range(500)]
    long += [(7001, t, "user", f"turn {t}" if t < 300 else "other") for t in range(310)]
    copies = [(c, t, "user", f"same {t}") for c in range(300) for t in range(3)]
    odd = [(9000, 0, "user", prose(1, 40000)), (9001, 0, "user", "x" * 300000), (9002, 1, "a", "b"), (9002, 1, "a", "b")]
    rows = long + copies + odd
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", "1 AS key", "2 AS words", "3 AS ids", "4 AS path", "5 AS n", "6 AS t")
    found = rows_of(trie.prefix_nodes(trie.sequences(df), 16))
    root = next(r for r in found if r[1] == 0)
    assert root[:5] == (0, 0, None, 305, 5) and root[5] == 6 and len(found) == 1 + 3 + 500 + 10 + 1 + 1 + 2
    same = next(r for r in found if r[0] == 0 and r[1] == 3)
    assert same[7] == hashlib.sha256(",".join(map(str, range(300))).encode()).hexdigest() and same[6] == 299 * 2
    assert root[6] == 3 * 299 * 2 + 300 * 2
    assert brute_force(by_turn(copies + odd).items()) == rows_of(trie.prefix_nodes(trie.sequences(spark.createDataFrame(copies + odd, ROWS)), 16))


def test_no_conversations(spark):
    empty = spark.createDataFrame([], ROWS)
    assert rows_of(trie.prefix_nodes(trie.with_shared_openings(trie.sequences(empty)))) == []
    assert rows_of(trie.prefix_nodes(trie.sequences(spark.createDataFrame([(None, 1, "a", "b")], ROWS)))) == []


def test_a_conversation_without_turns_ends_at_the_root(spark):
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 1)
    df = spark.createDataFrame([(c, 0, "user", "one")], ROWS)
    found = rows_of(trie.prefix_nodes(trie.with_shared_openings(trie.sequences(df))))
    assert found == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


@pytest.mark.parametrize("n", [3, 4, 5, 16, 17, 48, 49, 256])
def test_layouts_grow_with_their_children(n):
    tree = trie.Tree(2)
    labels = list(range(256))
    random.Random(n).shuffle(labels)
    for label in labels[:n]:
        tree.put(bytes([7, label]), [1], {1: trie.Mark(1, label)})
    node = tree.root.below.get(7)
    layout = trie.Few if n <= 16 else trie.Indexed if n <= 48 else trie.Full
    assert node.edge == b"\x07" and isinstance(node.below, layout)
    assert layout is not trie.Few or node.below.room == (4 if n <= 4 else 16)
    assert sorted(label for label, _ in node.below.items()) == sorted(labels[:n])
    assert all(node.below.get(label).marks[1].low == label for label in labels[:n])


def test_paths_are_compressed_and_only_whole_turns_are_nodes():
    tree = trie.Tree(4)
    tree.put(b"aaaabbbbcccc", [1, 2, 3], {3: trie.Mark(1, 5)})
    tree.put(b"aaaabbxx", [1, 7], {2: trie.Mark(1, 6)})
    assert [kid.edge for _, kid in tree.root.below.items()] == [b"aaaabb"]
    found = list(trie._nodes_of_block(tree, (b"", []), (b"", []), True, False))
    assert sorted((r["depth"], r["n_convs"], r["n_children"], r["n_leaves"]) for r in found) == [
        (0, 2, 1, 2), (1, 2, 2, 2), (2, 1, 0, 1), (2, 1, 1, 1), (3, 1, 0, 1)
    ]


def test_a_hot_opening_is_dealt_by_range(spark):
    """Sorted ranges split conversations that begin alike; the plan deals by key and conv_id."""
    rows = [(c, t, "user", "hello" if t == 0 else f"{c} {t}") for c in range(2000) for t in range(2)]
    found = trie.sequences(spark.createDataFrame(rows, ROWS))
    keyed = found.select("conv_id", F.unhex(F.array_join("ids", "")).alias("key"))
    sizes = keyed.repartitionByRange(4, "key", "conv_id").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 1000
    root = next(r for r in rows_of(trie.prefix_nodes(found, 64)) if r[1] == 0)
    assert root[3:6] == (2000, 1, 2000)
