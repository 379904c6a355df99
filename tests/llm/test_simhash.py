from itertools import combinations

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from larder.llm import simhash
from larder.llm.shared import Stored
from tests.llm.data import documents, joined, prose, with_clashes


def brute_fingerprint(text, size=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    grams = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_values(n, seed):
    draw = np.random.default_rng(seed)
    base = draw.integers(0, 1 << 63, n // 3, dtype=np.uint64)
    values = [int(base[k % len(base)]) for k in range(n)]
    for k in range(n):
        for b in draw.integers(0, 64, k % 6):
            values[k] ^= 1 << int(b)
    return np.array(values, np.uint64)


def test_fingerprint_is_the_engines_hash(spark):
    rows = [(1, "Ünï A b\tC\x0bd"), (2, "one two"), (3, ""), (4, None), (5, prose(1, 90)), (6, "a\x1cb c d e")]
    found = simhash.fingerprints(documents(spark, rows), 3).collect()
    assert {r["doc_id"]: r["fingerprint"] & (1 << 64) - 1 for r in found} == {i: brute_fingerprint(t) for i, t in rows}


@pytest.mark.parametrize("radius", [0, 1, 3, 20])
def test_bit_sliced_comparison(radius):
    values = near_values(333, radius)
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    bits = np.unpackbits(simhash.within_radius(values, radius).view(np.uint8), axis=1, bitorder="little")[:, :333]
    assert (bits.astype(bool) == (apart <= radius)).all()
    assert (simhash.distances_within(values, radius) == np.where(apart <= radius, apart, 255)).all()
    bounds = np.array([0, 90, 130, 300, 333])[[0, 1, 2, 3, 4]]
    order = np.argsort(-np.diff(bounds), kind="stable")
    shuffled = np.concatenate([np.arange(bounds[g], bounds[g + 1]) for g in order])
    links = simhash._neighbours(values[shuffled], np.append(0, np.cumsum(np.diff(bounds)[order])), radius)
    found = {(*sorted((int(shuffled[i]), int(shuffled[j]))), int(d)) for i, j, d in links}
    group = np.searchsorted(bounds, np.arange(333), side="right")
    expected = {(i, j, int(apart[i, j])) for i, j in combinations(range(333), 2) if group[i] == group[j] and apart[i, j] <= radius}
    assert found == expected


def test_near_fingerprints_share_a_block():
    masks = simhash.block_masks(3)
    draw = np.random.default_rng(0)
    for _ in range(300):
        flipped = sum(1 << int(b) for b in draw.choice(64, 3, replace=False))
        assert any(flipped & m == 0 for m in masks)


def test_links_find_all_reachable(spark):
    values = np.unique(near_values(400, 9))
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fingerprint long")
    links = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in simhash.near_links(df, 3, Stored(spark, "t")).collect()]
    members = values.tolist()
    near = [(a, b) for a, b in combinations(members, 2) if (a ^ b).bit_count() <= 3]
    assert joined(links, members) == joined(near, members)
    assert all((a ^ b).bit_count() <= 64 for a, b in links)


def test_classes_equal_brute_force(spark):
    text = prose(2, 300).split()
    rows = [(k, " ".join(text[: 300 - k])) for k in range(12)] + [(20, prose(3, 40)), (21, prose(3, 40).upper()), (22, None), (23, ""), (24, " \n"), (22, None), (None, prose(3, 40))]
    df = with_clashes(documents(spark, rows))
    found = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(df).collect()), key=str)
    prints = [brute_fingerprint(t) for _, t in rows]
    near = [(a, b) for a, b in combinations(range(len(rows)), 2) if (prints[a] ^ prints[b]).bit_count() <= 3]
    part = joined(near, range(len(rows)))
    least = {p: min(rows[k][0] for k in part if part[k] == p and rows[k][0] is not None) for p in part.values()}
    assert found == sorted(((rows[k][0], f"{prints[k]:016x}", least[part[k]]) for k in part), key=str)


def test_no_documents(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.without_similar(documents(spark, [])).count() == 0


def jaccard(a, b):
    def grams(t):
        w = (t or "").lower().split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())

    a, b = grams(a), grams(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_similar_texts_keep_one(spark):
    draw = np.random.default_rng(4)
    rows = []
    for g in range(15):
        base = prose(100 + g, 120).split()
        rows.append((g * 10, " ".join(base)))
        for c in range(1, 4):
            copy = list(base)
            for place in draw.choice(120, c, replace=False):
                copy[place] = f"changed{g}x{c}"
            rows.append((g * 10 + c, " ".join(copy)))
    rows += [(500, None), (501, ""), (502, prose(7, 3)), (None, prose(7, 3)), (502, prose(7, 3)), (503, prose(8, 5000))]
    df = with_clashes(documents(spark, rows))
    kept = simhash.without_similar(df)
    assert kept.columns == df.columns
    near = [(a, b) for a, b in combinations(range(len(rows)), 2) if jaccard(rows[a][1], rows[b][1]) >= 0.8]
    part = joined(near, range(len(rows)))
    expected = {min(rows[k][0] for k in part if part[k] == p and rows[k][0] is not None) for p in part.values()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)


def test_pipeline_keeps_one_of_each_simhash_class(spark):
    again = [" ".join([prose(50 + g, 30)] * 20) for g in range(4)]
    rows = [(g * 10, t) for g, t in enumerate(again)] + [(g * 10 + 5, f"{t} {prose(90 + g, 12)}") for g, t in enumerate(again)]
    rows += [(100, prose(3, 60)), (101, prose(3, 60).upper()), (102, None), (103, " "), (5, prose(4, 60)), (5, prose(4, 60)), (None, prose(4, 60)), (None, prose(6, 60))]
    prints = [brute_fingerprint(t) for _, t in rows]
    near = [(a, b) for a, b in combinations(range(len(rows)), 2) if (prints[a] ^ prints[b]).bit_count() <= 3]
    assert any(jaccard(rows[a][1], rows[b][1]) < 0.8 for a, b in near)
    part = joined(near, range(len(rows)))
    expected = [min((rows[k][0] for k in part if part[k] == p and rows[k][0] is not None), default=None) for p in set(part.values())]
    df = with_clashes(documents(spark, rows))
    kept = corpus_pipeline.near_duplicates_out(spark, df, "")
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(expected, key=str)
