from itertools import combinations

import numpy as np
import pytest

from larder.llm import vectors
from tests.llm.data import joined

KIND = "vec_id long, embedding array<float>, label int, a int, n_links int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], KIND)


def links(rows, cosine):
    points = {}
    for i, v in rows:
        v = np.array(v, np.float64)
        points[i] = v / np.linalg.norm(v)
    return [(a, b) for a, b in combinations(points, 2) if points[a] @ points[b] >= cosine]


def test_registered_table_equals_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    found = {r["vec_id"]: r for r in vectors.vector_classes(df).collect()}
    near = links(rows, 0.9)
    part = joined(near, [i for i, _ in rows])
    for i, _ in rows:
        assert found[i]["n_links"] == sum(i in p for p in near)
        assert found[i]["component_id"] == part[i] and found[i]["kept"] == (part[i] == i)


def test_recall_at_the_threshold(spark):
    draw = np.random.default_rng(0)
    rows, n = [], 700
    base = draw.standard_normal((n, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other = draw.standard_normal((n, 64))
    other -= (other * base).sum(1, keepdims=True) * base
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = draw.uniform(0.9, 1.0, (n, 1))
    twin = cosine * base + np.sqrt(1 - cosine**2) * other
    rows = [(2 * k, base[k].tolist()) for k in range(n)] + [(2 * k + 1, twin[k].tolist()) for k in range(n)]
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r["n_links"] for r in vectors.vector_classes(df).collect()}
    expected = links(rows, 0.9)
    assert sum(found.values()) <= 2 * len(expected)
    assert sum(found.values()) >= 0.9 * 2 * len(expected)


@pytest.mark.parametrize("tile", [8, 2048])
def test_dense_groups_and_odd_vectors(spark, monkeypatch, tile):
    monkeypatch.setattr(vectors, "tile_pairs", lambda *a, **k: real(*a, **k, tile=tile))
    draw = np.random.default_rng(2)
    centre = draw.standard_normal(16)
    good = [(k, (centre + 0.05 * draw.standard_normal(16)).tolist()) for k in range(60)]
    good += [(100 + k, draw.standard_normal(16).tolist()) for k in range(20)]
    good += [(200, good[0][1]), (201, (np.array(good[0][1]) * 1e20).tolist()), (202, [1.0, 2.0]), (203, [2.0, 4.0]), (204, [-1.0, 0.5])]
    bad = [(300, None), (301, [0.0] * 16), (302, [float("nan")] + [1.0] * 15), (303, [None] + [1.0] * 15), (304, []), (305, [float("inf")] * 16)]
    found = {r["vec_id"]: r for r in vectors.vector_classes(table(spark, good + bad)).collect()}
    same = [p for p in links([g for g in good if len(g[1]) == 16], 0.9)] + [(202, 203)]
    part = joined(same, [i for i, _ in good])
    for i, _ in good:
        assert found[i]["n_links"] == sum(i in p for p in same)
        assert found[i]["component_id"] == part[i]
    for i, _ in bad:
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True)


real = vectors.tile_pairs


def test_repeated_and_missing_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01]), (None, [1.0, 0.0])]
    found = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in vectors.vector_classes(table(spark, rows)).collect()), key=str)
    assert found == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (None, 0, None)]
    assert vectors.vector_classes(table(spark, [])).count() == 0
