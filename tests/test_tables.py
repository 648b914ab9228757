import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerleaf.operators import frame, graph, ordered
from ledgerleaf.session import shared_base
from ledgerleaf.sources.tables import spread


def test_running_total_and_positions(spark):
    rng = np.random.default_rng(1)
    values = rng.permutation(5000).tolist()
    df = spark.createDataFrame([(int(v), int(v) % 7) for v in values], "v INT, w INT").repartition(13)
    placed = ordered.with_position(df, [F.col("v")])
    assert placed.where("position <> v").count() == 0 and placed.count() == 5000
    total = ordered.with_running_total(df, [F.col("v")], F.col("w"), "run").orderBy("v").collect()
    assert [r.run for r in total] == np.cumsum([v % 7 for v in range(5000)]).tolist()
    assert ordered.all_but_last(df, [F.col("v")], 12).count() == 4988


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [5.0, 1.0, 1.0, 1.0, 9.0, 2.5], list(map(float, range(101)))])
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v DOUBLE")
    got = ordered.exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.75, 1.0]).first()
    assert np.allclose(list(got), np.quantile(values, [0, 0.25, 0.5, 0.75, 1]))


def test_sum_by_drops_missing_keys(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 5.0), ("b", None)], "k STRING, v DOUBLE")
    assert {tuple(r) for r in frame.sum_by(df, ["k"], "v", "s").collect()} == {("a", 1.0), ("b", 0.0)}


@pytest.mark.parametrize("limit", [0, 100])
def test_missing_keys_meet(spark, monkeypatch, limit):
    monkeypatch.setattr(frame, "BROADCAST_ROWS", limit)
    left = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "id INT, k STRING")
    right = spark.createDataFrame([(None, 10), ("x", 20)], "k STRING, c INT")
    got = {tuple(r) for r in frame.null_safe_left_join(left, right, "k", F.col("id")).select("id", "c").collect()}
    assert got == {(1, 10), (2, 20), (3, None)}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("rows", [0, 10])
def test_lookup_join_both_ways(spark, monkeypatch, how, rows):
    """A third of the facts share one key; broadcast and salted join agree."""
    facts = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    lookup = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    expected = {tuple(r) for r in facts.join(lookup, "k", how).select("id", "v").collect()}
    monkeypatch.setattr(frame, "BROADCAST_ROWS", rows * 100)
    got = frame.lookup_join(facts, lookup, "k", F.col("id"), how).select("id", "v").collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def test_rare_classes(spark):
    df = spark.createDataFrame([(i, "big" if i < 6 else "rare") for i in range(8)] + [(9, None)], "id INT, c STRING")
    got = {r.id: r.s for r in frame.rare_bucketed(df, "c", 2, "s").collect()}
    assert got[0] == "big" and got[7] == "Other" and got[9] is None


def test_codes(spark):
    df = spark.createDataFrame([(3, "a"), (1, "b"), (2, None), (4, "b")], "id INT, v STRING")
    assert {tuple(r) for r in frame.first_seen_codes(df, "v", "id", "c").collect()} == {("b", 1), (None, 2), ("a", 3)}
    assert {tuple(r) for r in frame.label_codes(df, "v", "c").collect()} == {("a", 0), ("b", 1)}


def test_hub_pages_hold_every_neighbour(spark):
    edges = spark.range(1700).select(
        F.concat(F.lit("d"), "id").alias("source"), F.lit("hub").alias("target"), F.lit("PERSON").alias("edge")
    )
    loop = spark.createDataFrame([("d1", "d1", "SELF"), ("d1", "hub", "PERSON")], edges.schema)
    titles = graph.adjacency_titles(edges.unionByName(loop))
    hub = titles.where("node = 'hub'").collect()
    assert len(hub) == 4 and {r.degree for r in hub} == {1700}
    listed = [n for r in hub for n in r.title.split(": ")[1].split("; ")]
    assert sorted(listed) == sorted(f"d{i}" for i in range(1700))
    own = titles.where("node = 'd1'").first()
    assert own.title == "d1: d1; hub" and own.degree == 2
    counts = {tuple(r) for r in graph.weighted_edges(edges.unionByName(loop)).where("source = 'd1'").collect()}
    assert counts == {("d1", "hub", "PERSON", 2), ("d1", "d1", "SELF", 1)}


def test_triples(spark):
    rows = spark.createDataFrame([(1, "Anna Berg met old friends near Rome. it was late. Solo went.")], "doc_id INT, text STRING")
    got = [tuple(r) for r in graph.triples(rows).orderBy("sent_no").select("source", "edge", "target").collect()]
    assert got == [("Anna Berg", "met old friends near", "Rome"), ("", "", ""), ("Solo", "", "")]


def test_table_view_and_pivot(spark):
    df = spark.range(20).select("id", (F.col("id") % 3).cast("string").alias("c"))
    page = frame.table_view(df, F.col("id") > 2, F.desc("c"), F.col("id"), page=1, size=4)
    assert [r.id for r in page.collect()] == [17, 4, 7, 10]
    pivot = frame.pivot_counts(df, "c", "c", ["0", "1", "2"])
    assert sum(r["0"] + r["1"] + r["2"] for r in pivot.collect()) == 20


def test_spread_leaves_enough_partitions_alone(spark):
    many = spark.range(0, 1000, 1, 64)
    assert spread(many, "id").rdd.getNumPartitions() == 64


def test_shared_base_is_stable(spark):
    assert shared_base(spark) == shared_base(spark)
