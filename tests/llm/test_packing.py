import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from larder.llm import packing
from tests.llm.data import documents, prose, with_clashes

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["a  b   c", " \n x\t\ty  ", "<|endoftext|> z", "ÄÖ 12,345 it's  q", "\x1c\x85 a", "😀 end ", "", "\n\n\n", "aaaa" * 500]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_the_tokenizers(spark, plain):
    encode = packing.encoder(PATH)
    texts = TEXTS + [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in texts:
        assert encode(text) == plain(text)
    assert encode("a <|endoftext|> b") == [64, 220, 50256, 275]
    as_text = Tokenizer.from_file(PATH)
    as_text.encode_special_tokens = True
    for text in TEXTS:
        assert packing.encoder(PATH, True)(text) == as_text.encode(text, add_special_tokens=False).ids


def test_pieces_hold_every_id_once(spark, plain):
    rows = [(k, prose(k, n)) for k, n in enumerate([3, 900, 5000, 1, 40, 700, 350, 12000] * 6)]
    rows += [(100 + k, t) for k, t in enumerate(TEXTS)] + [(200, None), (7, "again"), (None, "no id")]
    pieces = packing.packed(with_clashes(documents(spark, rows)).repartition(3), PATH).collect()
    ids = defaultdict(list)
    for i, text in rows:
        ids[i].append(np.array([*plain(text or ""), 0], "<u4"))
    by_sequence, by_doc = defaultdict(list), defaultdict(int)
    for p in pieces:
        same = [d for d in ids[p["doc_id"]] if len(d) == p["doc_tokens"]]
        span = slice(p["start"], p["start"] + p["length"])
        assert any(zlib.crc32(d[span].tobytes()) == p["ids_crc32"] for d in same)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
        by_doc[p["doc_id"]] += p["length"]
    assert by_doc == {i: sum(map(len, d)) for i, d in ids.items()}
    for spans in by_sequence.values():
        spans.sort()
        ends = np.cumsum([n for _, n in spans])
        assert [o for o, _ in spans] == [0, *ends[:-1]]
        assert ends[-1] <= 1024 and ends[-1] & (ends[-1] - 1) == 0  # no padding


def test_level_minimises_the_sum_of_squares():
    draw = np.random.default_rng(1)
    packer = packing.Packer(capacity=16)
    for size in draw.integers(1, 17, 400).tolist():
        def after(fill):
            levels = packer.levels.copy()
            if fill:
                levels[fill] -= 1
            if fill + size < 16:
                levels[fill + size] += 1
            return int((levels[1:16] ** 2).sum()), -fill

        choices = [0, *(f for f in range(1, 16 - size + 1) if packer.levels[f])]
        assert size == 16 or packer.level_for(size) == min(choices, key=after)
        list(packer.add(0, np.zeros(size, "<u4")))


def test_settling_when_many_windows_are_open():
    packer = packing.Packer(capacity=64, most_open=5)
    out = []
    for k in range(300):
        out += packer.add(k, np.full(k % 90 + 1, k, "<u4"))
        assert packer.n_open <= 5
    out += packer.settle()
    assert sum(len(p[4]) for p in out) == sum(k % 90 + 1 for k in range(300))


def test_no_documents(spark):
    assert packing.packed(documents(spark, []), PATH).count() == 0
