import pytest
from pyspark.sql import functions as F

from recordloom.operators.ordinal import preview, with_place


def test_places_equal_a_global_sort(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "nullif(id * 7919 % 13, 5) AS v").repartition(5)
    order = [F.col("v").desc_nulls_last(), F.col("id")]
    got = {r.id: r.place for r in with_place(df, order, folder=str(tmp_path), partitions=7).collect()}
    rows = sorted(
        ((r.v, r.id) for r in df.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1])
    )
    assert got == {i: n for n, (_, i) in enumerate(rows, 1)}


def test_ties_get_different_places(spark, tmp_path):
    df = spark.range(50).selectExpr("1 AS v")
    places = [r.place for r in with_place(df, [F.col("v")], folder=str(tmp_path)).collect()]
    assert sorted(places) == list(range(1, 51))


def test_empty_frame_and_taken_name(spark, tmp_path):
    df = spark.range(0).selectExpr("id AS v")
    assert with_place(df, [F.col("v")], folder=str(tmp_path)).count() == 0
    with pytest.raises(ValueError):
        with_place(df, [F.col("v")], name="v")


def test_preview_is_the_head_of_the_order(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS v")
    got = [tuple(r) for r in preview(df, [F.col("v").desc(), F.col("id")], 3).collect()]
    assert got == [(6, 6, 1), (13, 6, 2), (20, 6, 3)]
