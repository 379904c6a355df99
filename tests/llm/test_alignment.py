"""Alignment of two tokenizers' tokens against loops over single tokens, however texts are cut."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from larder.llm import alignment, queries
from larder.llm.alignment import NO_TOKENS, Fragment, Tokens, composed, fragment
from tests.llm.data import documents, prose, with_clashes

A, B = queries.token_file(), queries.token_file("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "a", "a  b   c ", " \n x\t\ty  ", "<|endoftext|> z <s> </s> <unk>", "ÄÖ 12,345 it's  q", "😀 end ", "▁x", "中文字 汉语",
    "\x00 a\x85b", "é ﬁ ½", "x" * 3000, "ab" * 2000 + " " + "cd " * 500, "a\nb\nc " * 700, "  lead", "trail  ", "▁",
]


class Loops:
    """The contract, token by token."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        known = alignment.tokenizers(A, B)
        self.a_bytes, self.b_bytes = known.a_bytes, known.b_bytes

    def tokens(self, text):
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        whole = (" " + text).encode()
        if not text or b"".join(self.a_bytes[i] for i in a) != whole or b"".join(self.b_bytes[i] for i in b) != whole:
            return [], []
        return a, b

    def document(self, text):
        a, b = self.tokens(text or "")

        def spans(ids, data):
            at, found = 0, []
            for i in ids:
                found.append((at, at + len(data[i]), i))
                at += len(data[i])
            return found

        a, b = spans(a, self.a_bytes), spans(b, self.b_bytes)
        cuts = sorted({y for _, y, _ in a} & {y for _, y, _ in b})
        held = {high: ([], []) for high in cuts}
        for side, tokens in enumerate((a, b)):
            k = 0
            for _, y, i in tokens:
                k += y > cuts[k]
                held[cuts[k]][side].append(str(i))
        groups = ["|".join(",".join(side) for side in held[high]) for high in cuts]
        links = Counter()
        k = 0
        for x, y, i in a:
            while k < len(b) and b[k][1] <= x:
                k += 1
            m = k
            while m < len(b) and b[m][0] < y:
                links[i, b[m][2]] += 1
                m += 1
        return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""

    def rows(self, docs):
        found = [(i, *self.document(t)) for i, t in docs]
        counts = Counter(pair for *_, links, _ in found for pair in links)
        best = {}
        for (i, _), n in counts.items():
            best[i] = max(best.get(i, 0), n)
        rows = []
        for i, n_a, n_b, groups, links, digest in found:
            n_best = sum(n for pair, n in links.items() if counts[pair] == best[pair[0]])
            rows.append((i, n_a, n_b, groups, sum(links.values()), n_best, sum(n * counts[pair] for pair, n in links.items()), digest))
        return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def loops():
    return Loops()


def rows_of(df):
    names = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    return sorted(map(tuple, df.select(*names).collect()), key=repr)


@pytest.mark.parametrize(("size", "block"), [(1 << 16, 1 << 21), (40, 300), (300, 5)])
def test_rows_equal_loops(spark, loops, size, block):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(100 + k, prose(k, n)) for k, n in enumerate([5, 60, 400, 3000])]
    rows += [(None, "no id here"), (3, "again a"), (3, "a"), (200, prose(2, 400)), (201, "中文字。" * 400 + " " + prose(9, 50))]
    docs = with_clashes(documents(spark, rows)).selectExpr("*", "1 AS pair", "2 AS place", "3 AS block", "4 AS part").repartition(3)
    assert rows_of(alignment.aligned(docs, A, B, size, block)) == loops.rows(rows)


def test_the_query_equals_loops(spark, loops):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert rows_of(queries.op11_token_alignment(spark, "/root/testdata/sf0.001")) == loops.rows(docs)


def test_ranges_have_the_tokens_of_the_whole(loops):
    known = alignment.tokenizers(A, B)
    draw = random.Random(4)
    parts = ["the", " ", "  ", "\n", "'s", " it's", "中", "▁", "x1", ".", " .", "\t", "é", "　", "😀"]
    for _ in range(400):
        text = "".join(draw.choice(parts) * draw.choice([1, 1, 2]) for _ in range(draw.randint(1, 80)))
        points = [*alignment.cut_points(text, 10, True), (len(text), len(text))]
        a = [i for k, ((x, _), (y, _)) in enumerate(zip(points, points[1:])) for i in known.encode_a(text[x:y] if k else " " + text[:y])]
        b = [i for k, ((_, x), (_, y)) in enumerate(zip(points, points[1:])) for i in known.pieces.encode(text[x + 1 : y] if k else text[:y])]
        assert a == loops.a.encode(" " + text, add_special_tokens=False).ids and b == loops.b.encode(text)


def random_tokens(draw, size):
    def ends(share):
        return np.array(sorted({*draw.sample(range(1, size), int(share * size)), size}), np.int64)

    a, b = ends(0.3), ends(0.4)
    return Tokens(np.arange(len(a)), a, 1000 + np.arange(len(b)), b)


def split(draw, tokens, n):
    """``tokens`` in n ranges, a and b cut at places of their own."""
    cut_a = [0, *sorted(draw.choices(range(len(tokens.a) + 1), k=n - 1)), len(tokens.a)]
    cut_b = [0, *sorted(draw.choices(range(len(tokens.b) + 1), k=n - 1)), len(tokens.b)]
    for (i, j), (k, m) in zip(zip(cut_a, cut_a[1:]), zip(cut_b, cut_b[1:])):
        yield Tokens(tokens.a[i:j], tokens.a_ends[i:j], tokens.b[k:m], tokens.b_ends[k:m])


def as_lists(tokens):
    return [p.tolist() for p in tokens.parts()]


@pytest.mark.parametrize("seed", range(30))
def test_fragments_compose_in_any_grouping(seed):
    draw = random.Random(seed)
    tokens = random_tokens(draw, draw.choice([6, 30, 120]))
    whole, closed = fragment(tokens)
    parts = [(f, [c]) for f, c in map(fragment, split(draw, tokens, draw.randint(1, 9)))]
    parts.insert(draw.randint(0, len(parts)), (Fragment(NO_TOKENS, None), []))
    while len(parts) > 1:
        k = draw.randrange(len(parts) - 1)
        (f, left), (g, right) = parts[k : k + 2]
        h, joint = composed(f, g)
        parts[k : k + 2] = [(h, [*left, joint, *right])]
    found, pieces = parts[0]
    assert as_lists(found.prefix) == as_lists(whole.prefix)
    assert found.suffix is not None and as_lists(found.suffix) == as_lists(whole.suffix)
    together = NO_TOKENS
    for piece in pieces:
        together = together + piece
    assert as_lists(together) == as_lists(closed)


def test_a_long_text_without_spaces_and_empty_tables(spark, loops):
    rows = [(1, "x" * 200000), (2, prose(3, 40000)), (3, "y")]
    assert rows_of(alignment.aligned(documents(spark, rows), A, B)) == loops.rows(rows)
    assert rows_of(alignment.aligned(documents(spark, []), A, B)) == []
    assert rows_of(alignment.aligned(documents(spark, [(1, None)]), A, B)) == [(1, 0, 0, 0, 0, 0, 0, "")]
