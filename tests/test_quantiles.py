import numpy as np
import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import quantiles
from tidemark.operators.quantiles import exact_medians, impute_median


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.floats(allow_nan=False, allow_infinity=False, min_value=-1e300, max_value=1e300) | st.integers(-5, 5),
        min_size=1,
        max_size=60,
    )
)
def test_median_is_exact(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = exact_medians(df, ["x"]).first().x
    assert got == pytest.approx(float(np.median([float(v) for v in values])), rel=1e-12, abs=0)


def test_many_values_in_one_magnitude(spark):
    """More distinct values than one pass has buckets."""
    df = spark.range(300_001).selectExpr("1000000 + id * 0.5 AS x", "cast(id % 7 AS int) AS y")
    row = exact_medians(df, ["x", "y"]).first()
    assert (row.x, row.y) == (1_075_000.0, 3.0)


def test_missing_values_do_not_count(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (float("nan"),), (4.0,), (5.0,)], "x double")
    assert exact_medians(df, ["x"]).first().x == 3.0


def test_empty_column_has_no_median(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "x double, y double")
    row = exact_medians(df, ["x", "y"]).first()
    assert (row.x, row.y) == (None, 1.5)
    filled = impute_median(df, ["x", "y"]).collect()
    assert [r.x for r in filled] == [None, None]


@pytest.mark.parametrize("broadcast_groups", [0, 10])
def test_median_by_skewed_group(spark, broadcast_groups):
    """Half the rows are in one group, and half of those are copies of one value."""
    df = spark.range(4000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 0 ELSE id % 9 END AS g",
        "CASE WHEN id % 4 = 0 THEN 7.25D ELSE cast(pmod(xxhash64(id), 1000) AS double) / 3 END AS x",
    )
    want = df.toPandas().groupby("g")["x"].median().to_dict()
    got = {r.g: r.x for r in exact_medians(df, ["x"], "g", broadcast_groups).collect()}
    assert got == pytest.approx(want)
    filled = impute_median(df, ["x"], "g", broadcast_groups)
    assert filled.count() == 4000


def test_integers_over_their_whole_range(spark):
    values = [-(2**31), -70_000, -1, 0, 3, 65_536, 2**31 - 1, 2**31 - 1]
    df = spark.createDataFrame([(v,) for v in values], "x int")
    assert exact_medians(df, ["x"]).first().x == 1.5


def test_fill_by_group(spark):
    rows = [("a", 1), ("a", 3), ("a", None), ("b", 10), ("b", None), ("c", None)]
    df = spark.createDataFrame(rows, "g string, x int")
    got = sorted((r.g, r.x) for r in impute_median(df, ["x"], by="g").where("g <> 'c'").collect())
    assert got == [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 10.0), ("b", 10.0)]
    assert impute_median(df, ["x"], by="g").count() == 6


def test_close_values_leave_a_bounded_last_window(spark):
    """Most values within 2e-8 of each other: ranges narrow until few are left."""
    close = spark.range(60_000).select((F.lit(1.0) + F.col("id") * 3e-13).alias("v"))
    wide = spark.createDataFrame([(float(i),) for i in range(-50, 50)], "v double")
    rows = close.unionByName(wide)
    median = exact_medians(rows, ["v"]).first()["v"]
    want = sorted([1.0 + i * 3e-13 for i in range(60_000)] + [float(i) for i in range(-50, 50)])
    assert median == (want[30_049] + want[30_050]) / 2


def test_nan_is_filled_like_null(spark):
    rows = spark.createDataFrame([(1.0,), (3.0,), (None,), (float("nan"),)], "v double")
    assert sorted(r["v"] for r in impute_median(rows, ["v"]).collect()) == [1.0, 2.0, 2.0, 3.0]


@pytest.mark.parametrize("margins,scans", [((0.005, 0.05, 0.5), 1), ((1e-12, 0.5), 2)])
@pytest.mark.parametrize("one_task", [0, 1_000_000])
def test_two_scans_unless_a_bracket_is_widened(spark, monkeypatch, margins, scans, one_task):
    """More distinct values than the sketch holds; brackets ordered by one task or in ranges."""
    seen = []
    second = quantiles._inside_brackets

    def counted(df, brackets):
        found = second(df, brackets)
        seen.append({c: found.where(F.col("name") == c).count() for c in brackets})
        return found

    monkeypatch.setattr(quantiles, "_MARGINS", margins)
    monkeypatch.setattr(quantiles, "_ONE_TASK", one_task)
    monkeypatch.setattr(quantiles, "_inside_brackets", counted)
    df = spark.range(60_000).select(
        (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1000).alias("x"), F.exp(F.randn(3) * 5).alias("y"), F.lit(None).cast("double").alias("z")
    ).repartition(6).persist()
    row = exact_medians(df, ["x", "y", "z"]).first()
    table = df.toPandas()
    assert (row.x, row.y, row.z) == (np.median(table["x"]), np.median(table["y"]), None)
    assert len(seen) == scans
    if scans == 1:
        assert max(seen[0].values()) < 0.03 * 60_000
    df.unpersist()


def test_infinite_values_have_a_place(spark):
    inf = float("inf")
    df = spark.createDataFrame([(-inf,), (-inf,), (1.0,), (2.0,), (inf,)], "x double")
    assert exact_medians(df, ["x"]).first().x == 1.0
