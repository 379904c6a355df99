import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from larder.llm import lm
from tests.llm.data import documents, prose, with_clashes


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lowered) if w] + ["\n"]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


ROWS = [(k, prose(k % 90, 60) + f" own{k}") for k in range(160)]
ROWS += [(200, None), (201, ""), (201, ""), (None, "Ü a\x0bb A"), (202, prose(5, 20_000)), (203, "the " * 300)]


def test_counts_and_base_equal_brute_force(spark):
    found = lm.scored(with_clashes(documents(spark, ROWS)).repartition(3), n_buckets=5).collect()
    counts = Counter(t for i, text in ROWS if not held(i) for t in tokens(text))
    n, v = counts.total(), len(counts)
    expected = sorted(
        (str(i), held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 6))
        for i, t in ROWS
    )
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == expected
    for r in found:
        assert r["score"] < 0 and math.isclose(r["perplexity"], 10 ** (-r["score"] / r["n_tokens"]))


def test_beats_the_unigram_model_on_held_out_copies(spark):
    found = lm.scored(documents(spark, ROWS)).collect()
    some = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in some) > sum(r["base_score"] for r in some)


def state(rows, n_buckets, hot=()):
    import pyarrow as pa

    from pyspark import TaskContext

    parts = {}
    batch = pa.record_batch([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows])], names=["doc_id", "text"])
    context = lm.TaskContext
    lm.TaskContext = type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 0})())})
    try:
        for out in lm._occurrences(n_buckets, np.array(sorted(hot), np.uint64))(iter([batch])):
            for b, c, d in zip(*(out[k].to_pylist() for k in ("bucket", "chunk", "data"))):
                parts.setdefault(b, []).append((c, lm._unpack(d)))
    finally:
        lm.TaskContext = context
    return {b: lm.Bucket.merged(p) for b, p in parts.items() if b != lm._DOCS}


@pytest.mark.parametrize("hot", [(), ("the", "\n")])
def test_buckets_hold_every_occurrence(hot):
    rows = [(k, t) for k, t in ROWS if k is not None][:60] + [(203, "the " * 300)]
    buckets = state(rows, 4, [int(lm.word_hashes([w.encode()])[0]) for w in hot])
    pairs = Counter()
    for i, t in rows:
        own = tokens(t)
        for before, word in zip([None, *own], own):
            h = lm.word_hashes([word.encode()])
            c = lm.CONTEXTS if before is None else int(lm.mixed(lm.word_hashes([before.encode()]))[0] % np.uint64(lm.CONTEXTS))
            pairs[int(h[0]), c] += not held(i)
    got = Counter()
    for b in buckets.values():
        again = lm.Bucket.unpacked(b.packed())
        for name in ("dish", "type_dish", "context", "count", "uses", "chunk", "doc"):
            assert (getattr(b, name) == getattr(again, name)).all()
        for d, c, n in zip(b.dish[b.type_dish].tolist(), b.context.tolist(), b.count.tolist()):
            assert (d, c) not in got
            got[d, c] = n
    assert got == pairs
    assert sum(b.uses.sum() for b in buckets.values()) == sum(len(tokens(t)) for _, t in rows)


def test_probabilities_of_a_context_add_up():
    rows = [(k, t) for k, t in ROWS if not held(k)]
    bucket = state(rows, 1)[0]
    tables = (bucket.count > 0).astype(float)
    c, t = (np.bincount(bucket.context, x, minlength=lm.CONTEXTS + 1) for x in (bucket.count, tables))
    totals = lm.Totals(c, t, 0.7, len(bucket.dish), int(bucket.count.sum()), np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), float(tables.sum()), float(len(bucket.dish)))
    seating = lm.Seating(bucket, totals, 1)
    for _ in range(4):
        seating.sweep()
        totals.root_tables, totals.root_customers = seating.root_tables.sum(), seating.customers.sum()
    seating._seat_root()
    totals.root_tables = seating.root_tables.sum()
    d, s, base = totals.root_discount, totals.strength, 1 / (totals.n_words + 1)
    root = (np.maximum(seating.customers - d * seating.root_tables, 0) + (s + d * totals.root_tables) * base) / (s + totals.root_customers)
    unknown = (s + d * totals.root_tables) * base / (s + totals.root_customers)
    assert abs(root.sum() + unknown - 1) < 1e-9
    seating.root = root
    p = seating.probabilities()
    here = np.bincount(bucket.context, seating.tables, minlength=lm.CONTEXTS + 1)
    for context in np.unique(bucket.context)[:40]:
        own = bucket.context == context
        rest = 1 - root[bucket.type_dish[own]].sum()
        back = (s + totals.discount * here[context]) / (s + c[context])
        assert abs(p[own].sum() + back * rest - 1) < 1e-9


def test_seating_follows_the_restaurant():
    """The numbers of tables have the distribution of the process, also for large parties."""
    draw = np.random.default_rng(0)
    for customers, steps in ((12, 12), (3000, 3000)):
        tables, weight = lm.seat(np.full(4000, customers), np.full(4000, 2.0), np.full(4000, 0.5), 0.5, draw)
        mean, t = 0.0, np.ones(4000)
        for i in range(1, customers):
            new = (2.0 + 0.5 * t) / (i + 2.0)
            t += draw.random(4000) < new
        mean = t.mean()
        assert abs(tables.mean() - mean) < 0.05 * mean
        assert (tables <= customers).all() and np.isfinite(weight).all()
    one, _ = lm.seat(np.array([0, 1]), np.ones(2), np.ones(2), 0.5, draw)
    assert one.tolist() == [0, 1]


def test_sweeps_sample_the_posterior():
    """For one dish the accepted seatings follow the exact distribution of the tables."""
    draw, c, d, a = np.random.default_rng(1), 5, 0.6, 0.3
    ways = np.zeros((c + 1, c + 1))
    ways[1, 1] = 1
    for n in range(1, c):
        for t in range(1, n + 2):
            ways[n + 1, t] = ways[n, t - 1] + (n - d * t) * ways[n, t]
    exact = ways[c, 1:] * np.array([np.prod([a + 0.2 * k for k in range(t)]) for t in range(1, c + 1)])
    exact /= exact.sum()
    state_t, state_w = np.zeros(40_000), np.full(40_000, -np.inf)
    for _ in range(15):
        t, w = lm.seat(np.full(40_000, c), np.full(40_000, a), np.full(40_000, 0.2), d, draw)
        taken = np.log(draw.random(40_000)) < w - state_w
        state_t[taken], state_w[taken] = t[taken], w[taken]
    seen = np.bincount(state_t.astype(int), minlength=c + 1)[1:] / 40_000
    assert np.abs(seen - exact).max() < 0.01


def test_no_documents(spark):
    assert lm.scored(documents(spark, [])).count() == 0


def test_sums_combine_over_buckets_and_are_handed_on_beyond_the_limit():
    draw = np.random.default_rng(5)
    for limit in (0, 7, 10_000):
        waiting, expected, batches = lm._Sums(limit), {}, []
        for _ in range(6):
            key = np.unique(draw.integers(0, 5, 30) * (1 << 16) + draw.integers(0, 9, 30))
            sums = [draw.random(len(key)).round(3) for _ in range(3)]
            sums[0] = np.ceil(sums[0])
            batches += waiting.add(key, sums)
            for k, *values in zip(key.tolist(), *(s.tolist() for s in sums)):
                expected[k] = [a + b for a, b in zip(expected.get(k, [0, 0, 0]), values)]
        batches += waiting.rows()
        found = {}
        for batch in batches:
            for chunk, data in zip(batch["chunk"].to_pylist(), batch["data"].to_pylist()):
                p = lm._unpack(data)
                for doc, *values in zip(*(p[c].tolist() for c in ("doc", "known", "base", "score"))):
                    k = (chunk << 16) + doc
                    found[k] = [a + b for a, b in zip(found.get(k, [0, 0, 0]), values)]
        assert found.keys() == expected.keys()
        assert all(np.allclose(found[k], expected[k], atol=1e-12) for k in found)
        assert not list(waiting.rows())
