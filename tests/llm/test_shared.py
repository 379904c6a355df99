from itertools import combinations

import numpy as np
import pytest

from pyspark.sql import functions as F

from larder.llm import graph, words
from larder.llm.graph import components
from larder.llm.shared import Stored
from larder.llm.tiles import in_units, linked_parts, tile_pairs, units
from tests.builders import final_plan
from tests.llm.data import joined


@pytest.mark.parametrize("seed", range(2))
def test_components_equal_union_find(spark, seed):
    draw = np.random.default_rng(seed)
    edges = [tuple(map(int, e)) for e in draw.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(400, 440)]
    df = spark.createDataFrame([*edges, (7, None), (None, None)], "a long, b long")
    found = {r["id"]: r["component"] for r in components(df, Stored(spark, "t")).collect()}
    proper = [e for e in edges if e[0] != e[1]]
    expected = joined(proper, {v for e in proper for v in e})
    assert found == expected


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([(1, 1)], "a long, b long"), Stored(spark, "t")).count() == 0


@pytest.mark.parametrize("within", [False, True])
def test_tiles_meet_every_pair_in_bounded_units(spark, within):
    rows = [("hot", k) for k in range(60)] + [("two", k) for k in range(100, 102)] + [("one", 500)]
    df = spark.createDataFrame(rows, "g string, m long")
    dealt = in_units(tile_pairs(df, ["g"], "m", Stored(spark, "t"), tile=8, within=within), ["g"], ["m"])
    seen = {}
    for r in dealt.collect():
        seen.setdefault((r["g"], r["tile_a"], r["tile_b"]), []).append(r["m"])
    met = {frozenset(p) for unit in seen.values() for p in combinations(unit, 2)}
    assert {frozenset(p) for g in ("hot", "two") for p in combinations([m for x, m in rows if x == g], 2)} <= met
    assert max(map(len, seen.values())) < 40
    assert "one" not in {g for g, _, _ in seen}


HOT = dict(
    spark__sql__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
    spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
)


def test_hot_group_is_split_before_it_is_dealt(spark, conf):
    """A third of all rows in one group: the join that brings its size splits it over tasks."""
    conf(**HOT)
    stored = Stored(spark, "t")
    rows = stored.write(spark.range(0, 30000, 1, 6).selectExpr("if(id % 3 = 0, -1, id div 2) as g", "id as m"))
    dealt = tile_pairs(rows, ["g"], "m", stored)
    assert "skew=true" in final_plan(dealt)
    assert dealt.where("g = -1").select("m").distinct().count() == 10000


def test_hot_vertex_is_split(spark, conf):
    """A third of all edges and more at one vertex: both joins of a round split it over tasks."""
    conf(**HOT)
    stored = Stored(spark, "t")
    ends = spark.range(1, 30001, 1, 6).selectExpr("id % 3 < 2 as hot", "xxhash64(id) & 72057594037927935 as v")
    edges = stored.write(ends.selectExpr("v as hi", "if(hot, 0, v - 1) as lo"))
    both = graph._both_ways(edges)
    large = graph._large_star(both, stored.write(both.groupBy("u").agg(F.min("v").alias("least"))))
    assert "skew=true" in final_plan(large)
    hung = stored.write(ends.selectExpr("if(hot, 1L << 60, v + 1) as hi", "v as lo"))
    small = graph._small_star(hung, stored.write(hung.groupBy("hi").agg(F.min("lo").alias("least"))))
    assert "skew=true" in final_plan(small)
    found = components(edges.selectExpr("hi as a", "lo as b"), stored)
    assert found.groupBy("component").count().agg(F.max("count"), F.count("*")).first() == (20001, 10001)


def test_units_survive_batch_bounds(spark):
    import pyarrow as pa

    groups = np.repeat(np.arange(50), 7)
    zero = np.zeros(len(groups), np.int64)
    table = pa.table({"g": groups, "tile_a": zero, "tile_b": zero, "v": np.arange(len(groups))})
    got = []
    for part, bounds in units(iter(table.to_batches(max_chunksize=11)), ["g"]):
        got += [part["v"].to_pylist()[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    assert got == [list(range(k * 7, k * 7 + 7)) for k in range(50)]


def test_linked_parts():
    draw = np.random.default_rng(3)
    links = draw.random((130, 130)) < 0.008
    links |= links.T
    expected = joined(list(zip(*np.nonzero(links))), range(130))
    assert linked_parts(links).tolist() == [expected[k] for k in range(130)]


def test_run_hashes_depend_on_words_only():
    h = words.word_hashes([b"a", b"b", b"c", b"a", b"b", b"c", b"b", b"a"])
    runs = words.run_hashes(h, 3)
    assert runs[0] == runs[3] and len(set(runs.tolist())) == 5
    assert words.run_hashes(h[3:], 3)[0] == runs[0]
    assert len(words.run_hashes(h, 9)) == 0
