"""Encoding and decoding against the tokenizer library, whatever the chunks."""

import hashlib
import json
import random
import time

import numpy as np
import pytest
from tokenizers import Tokenizer

from larder.llm import bpe, queries
from tests.llm.data import documents, prose, with_clashes

PATH = queries.token_file()
PIECES = [
    "a", "the", "'", "'re", "'ll", "'s", " ", "  ", "\n", "\t", "1", "23", "!", "--", "é", "😀", "<|endoftext|>", "<|endo", "|>",
    "　", "中文", "ing", " neighbourhood", "s", "====", "\x1c", "\x85", "ñ",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def known():
    return bpe.vocabulary(PATH)


def random_texts(seed, n):
    draw = random.Random(seed)
    for _ in range(n):
        yield "".join(draw.choice(PIECES) * draw.choice([1, 1, 2, 3, draw.choice([1, 50, 700])]) for _ in range(draw.randint(0, 20)))


def test_any_chunks_give_the_librarys_ids(known, library):
    draw = random.Random(5)
    for text in random_texts(1, 600):
        size = draw.choice([1, 2, 3, 7, 50, 10000])
        chunks = [text[k : k + size] for k in range(0, len(text), size)]
        assert [i for piece in known.encode(chunks) for i in piece] == library.encode(text, add_special_tokens=False).ids


def test_special_tokens_as_text(library):
    known = bpe.vocabulary(PATH, True)
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    for text in random_texts(2, 150):
        assert list(known.ids(text)) == plain.encode(text, add_special_tokens=False).ids


def test_ids_of_all_characters(known, library):
    for low in [*range(0, 0x3400, 0x80), 0xA000, 0xFE00, 0x1F600, 0xE0000]:
        text = "".join(f"a{chr(c)}b 1{chr(c)}2 !{chr(c)}. {chr(c)}" for c in range(low, low + 0x80))
        assert list(known.ids(text)) == library.encode(text, add_special_tokens=False).ids


def test_any_ids_decode_as_the_librarys(known, library):
    draw = random.Random(3)
    for _ in range(1500):
        ids = [draw.randrange(50300) for _ in range(draw.randint(0, 12))]
        states = bpe.Decoding(known)
        assert "".join(states.feed([i]) for i in ids) + states.finish() == library.decode(ids, skip_special_tokens=False)


def small_merges(seed, n):
    draw = random.Random(seed)
    tokens, merges = [b"a", b"b", b"c"], []
    while len(merges) < n:
        u, v = draw.choice(tokens), draw.choice(tokens)
        if u + v not in tokens and len(u + v) <= 9:
            tokens.append(u + v)
            merges.append((u, v))
    return merges


def vocabulary_file(tmp_path, merges):
    letters = {b: c for c, b in bpe.byte_letters().items()}
    shown = [tuple("".join(letters[b] for b in part) for part in m) for m in merges]
    vocab = {letters[b]: b for b in range(256)} | {u + v: 256 + k for k, (u, v) in enumerate(shown)}
    spec = {
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None, "post_processor": None,
        "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
        "decoder": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True},
        "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None,
                  "fuse_unk": False, "byte_fallback": False, "vocab": vocab, "merges": [" ".join(m) for m in shown]},
    }
    path = tmp_path / "merges.json"
    path.write_text(json.dumps(spec))
    return str(path)


@pytest.mark.parametrize("seed", range(8))
def test_lookahead_suffices_for_other_merge_lists(tmp_path, seed):
    """Ends of tokens that lie the lookahead before the end never depend on what follows."""
    known = bpe.Vocabulary(vocabulary_file(tmp_path, small_merges(seed, 25)))
    library = Tokenizer.from_file(str(tmp_path / "merges.json"))
    draw = random.Random(seed)

    def ends(data):
        return np.cumsum([len(known.bytes_of[i]) for i in known.merged(data)]).tolist()

    for _ in range(150):
        text = bytes(draw.choice(b"abc") for _ in range(known.lookahead + draw.randint(0, 40)))
        sure = {e for e in ends(text) if e <= len(text) - known.lookahead}
        for _ in range(6):
            longer = text + bytes(draw.choice(b"abc") for _ in range(draw.randint(1, 12)))
            assert sure == {e for e in ends(longer) if e <= len(text) - known.lookahead}
        whole = (text * 30).decode()
        assert list(known.ids(whole)) == library.encode(whole, add_special_tokens=False).ids


def test_merge_lists_that_are_not_proper_are_refused():
    with pytest.raises(ValueError, match="not proper"):
        bpe.sufficient_lookahead([(b"a", b"bc")])
    with pytest.raises(ValueError, match="not proper"):
        bpe.sufficient_lookahead([(b"a", b"b"), (b"b", b"c"), (b"ab", b"c"), (b"a", b"bc")])


def test_memory_and_time_of_a_word_without_end(known, library):
    draw = random.Random(7)
    part = bpe._Part(known)
    start, count = time.time(), 0
    for _ in range(64):
        count += len(part.feed("".join(draw.choice("abcdefghij") for _ in range(4096))))
        assert len(part.tail) + len(part.data) <= known.window + 4096
    assert count > 50000 and time.time() - start < 60


def test_round_trip_of_rows(spark, library):
    rows = [(k, t) for k, t in enumerate([*random_texts(9, 60), None, "", "", prose(1, 30000), "x" * 200000])]
    rows += [(None, "no id"), (3, "again <|endoftext|>")]
    docs = with_clashes(documents(spark, rows)).repartition(3)
    expected = sorted(((i, tuple(library.encode(t or "", add_special_tokens=False).ids), t or "") for i, t in rows), key=repr)
    for back in (bpe.decoded(bpe.encoded(docs, PATH), PATH), bpe.round_trip(docs, PATH)):
        found = [(r["doc_id"], tuple(bpe.from_little_endian(r["ids"])), r["text"]) for r in back.collect()]
        assert sorted(found, key=repr) == expected


def test_digests_of_the_query(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    found = queries.op12_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_no_documents(spark):
    assert bpe.decoded(bpe.encoded(documents(spark, []), PATH), PATH).count() == 0
