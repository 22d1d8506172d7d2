from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from panelwatch.operators.panel import MONTH, WEEK, densify, sparse_panel
from panelwatch.operators.trend import rank_and_share, trend

MONDAY = date(2020, 1, 6)
LINE = ["series", "place"]


def week(n):
    return MONDAY + timedelta(weeks=n)


def sparse_of(spark, cells):
    """cells: (series, place, week number, metric, denominator)"""
    data = [(s, p, week(n), m, d) for s, p, n, m, d in cells]
    return spark.createDataFrame(data, "series string, place string, week date, metric long, denominator long")


def dense_of(spark, cells, places, cluster_by=LINE):
    return densify(
        sparse_of(spark, cells),
        spark.createDataFrame([(p,) for p in places], "place string"),
        series=["series"], entity="place", period="week", step=WEEK,
        metric="metric", denominator="denominator", cluster_by=cluster_by,
    )


def trend_of(dense):
    return trend(
        dense, line=LINE, period="week", metric="metric", averages={"ma4": 4, "ma8": 8},
        previous="prev", change="change", growth="growth",
    )


def test_zero_fill_keeps_missing_denominators_null(spark):
    dense = dense_of(spark, [("s", "a", 0, 4, 10), ("s", "a", 2, 8, 20)], ["a"])
    assert rows(dense.select("week", "metric", "denominator"), "week") == [
        (week(0), 4, 10), (week(1), 0, None), (week(2), 8, 20),
    ]


def test_unlisted_entity_extends_the_span_but_is_not_shown(spark):
    dense = dense_of(spark, [("s", "a", 1, 5, None), ("s", "未知", 3, 7, None)], ["a", "b"])
    assert rows(dense.select("place", "week", "metric"), "place", "week") == [
        ("a", week(1), 5), ("a", week(2), 0), ("a", week(3), 0),
        ("b", week(1), 0), ("b", week(2), 0), ("b", week(3), 0),
    ]


def test_each_series_has_its_own_span(spark):
    dense = dense_of(spark, [("s", "a", 0, 1, 1), ("s", "a", 2, 1, 1), ("t", "a", 5, 1, 1)], ["a"])
    assert rows(dense.groupBy("series").count(), "series") == [("s", 3), ("t", 1)]


def test_moving_averages_and_growth(spark):
    cells = [("s", "a", n, m, None) for n, m in enumerate([4, 0, 8, 4, 0])]
    got = rows(trend_of(dense_of(spark, cells, ["a"])).select("ma4", "prev", "change", "growth", "week"), "week")
    assert [r[0] for r in got] == [4.0, 2.0, 4.0, 4.0, 3.0]
    assert [r[1] for r in got] == [None, 4, 0, 8, 4]
    assert [r[2] for r in got] == [None, -4, 8, -4, -4]
    assert [r[3] for r in got] == [None, -100.0, None, -50.0, -100.0]


@pytest.mark.parametrize("wide", [False, True])
def test_rank_and_share(spark, wide):
    cells = [("s", p, 0, m, None) for p, m in zip("abc", [5, 5, 0])]
    cells += [("s", p, 1, 0, None) for p in "abc"]
    ranked = rank_and_share(
        dense_of(spark, cells, "abc", ["series", "week"]),
        within=["series", "week"], metric="metric", rank="rank", share="share", wide=wide,
    )
    assert rows(ranked.select("week", "place", "rank", "share"), "week", "place") == [
        (week(0), "a", 1, 50.0), (week(0), "b", 1, 50.0), (week(0), "c", 3, 0.0),
        (week(1), "a", 1, None), (week(1), "b", 1, None), (week(1), "c", 1, None),
    ]


cell = st.tuples(
    st.sampled_from("st"), st.sampled_from(["a", "b", "未知"]), st.integers(0, 9),
    st.integers(0, 50), st.one_of(st.none(), st.integers(0, 9)),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(cell, min_size=1, max_size=25, unique_by=lambda c: c[:3]))
def test_panel_against_brute_force(spark, cells):
    places = ["a", "b", "c"]
    observed = {c[:3]: c[3:] for c in cells}
    expected = {}
    for s in {c[0] for c in cells}:
        spanned = [c[2] for c in cells if c[0] == s]
        for p in places:
            line = []
            for n in range(min(spanned), max(spanned) + 1):
                metric, denominator = observed.get((s, p, n), (0, None))
                before = line[-1] if line else None
                line.append(metric)
                mean = sum(line[-4:]) / len(line[-4:])
                expected[(s, p, week(n))] = (metric, denominator, before, int(mean * 10 + 0.5) / 10)
    dense = trend_of(dense_of(spark, cells, places))
    got = {tuple(r)[:3]: tuple(r)[3:] for r in dense.select(*LINE, "week", "metric", "denominator", "prev", "ma4").collect()}
    assert got == expected


def test_wide_rank_equals_window_rank(spark):
    dense = spark.range(2000).select(
        F.lit("s").alias("series"),
        F.lit(MONDAY).alias("week"),
        F.col("id").alias("place"),
        # A third of all entities share one value.
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 101).cast("long").alias("metric"),
    )
    one, two = (
        rank_and_share(dense, within=["series", "week"], metric="metric", rank="rank", share="share", wide=w)
        for w in (False, True)
    )
    assert one.exceptAll(two.select(one.columns)).isEmpty()
    assert two.count() == 2000


@pytest.mark.parametrize("wide", [False, True])
def test_filters_pass_through_both_rank_forms(spark, tmp_path, wide):
    cells = [("s", p, n, n, None) for p in "abc" for n in range(4)] + [("t", "a", 0, 1, None)]
    dense_of(spark, cells, "abc", ["series", "week"]).write.parquet(str(tmp_path / "dense"))
    dense = spark.read.parquet(str(tmp_path / "dense"))
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    ranked = rank_and_share(dense, within=["series", "week"], metric="metric", rank="rank", share="share", wide=wide)
    one = ranked.where((F.col("series") == "s") & (F.col("week") == week(2)))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(series,s)") == plan.count("EqualTo(week,") == (2 if wide else 1)
    assert one.count() == 3


def test_monthly_panel_without_series(spark):
    sparse = spark.createDataFrame(
        [("a", date(2021, 11, 1), 3), ("b", date(2022, 2, 1), 1)], "place string, month date, cases long"
    )
    dense = densify(
        sparse, spark.createDataFrame([("a",), ("b",)], "place string"),
        series=[], entity="place", period="month", step=MONTH, metric="cases", cluster_by=["place"],
    )
    months = [date(2021, 11, 1), date(2021, 12, 1), date(2022, 1, 1), date(2022, 2, 1)]
    assert rows(dense.select("place", "month", "cases"), "place", "month") == [
        *[("a", m, n) for m, n in zip(months, [3, 0, 0, 0])],
        *[("b", m, n) for m, n in zip(months, [0, 0, 0, 1])],
    ]


def test_empty_observations_give_an_empty_panel(spark):
    assert dense_of(spark, [], ["a"]).isEmpty()


def test_sparse_panel_sums_and_keeps_all_null_sums(spark):
    data = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("b", None, 4)], "k string, m int, d int")
    got = sparse_panel(data, ["k"], metric=F.col("m"), denominator=F.col("d"))
    assert rows(got, "k") == [("a", 3, None), ("b", None, 4)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dense_trend_moves_its_rows_once(spark):
    text = plan(trend_of(dense_of(spark, [("s", "a", 0, 1, 1), ("s", "b", 3, 1, 1)], ["a", "b"])))
    above_union = text.split("Union")[0]
    assert above_union.count("Exchange") == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_dense_rank_moves_its_rows_once(spark):
    dense = dense_of(spark, [("s", "a", 0, 1, 1)], ["a"], ["series", "week"])
    ranked = rank_and_share(dense, within=["series", "week"], metric="metric", rank="rank", share="share")
    assert plan(ranked).split("Union")[0].count("Exchange") == 1
