"""Aggregates and the analytic views on them.

`agg_weekly` and `agg_monthly` are sums of facts to the common grain; a build writes
them, as every view reads them and they are small next to the facts. The views are lazy.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwatch.functions import calendar
from panelwatch.functions.measures import rate
from panelwatch.operators.lookup import lookup
from panelwatch.operators.panel import MONTH, WEEK, densify, sparse_panel
from panelwatch.operators.trend import rank_and_share, trend
from panelwatch.plans.dimensions import iso_weeks
from panelwatch.plans.schema import UNKNOWN_COUNTY

Tables = Mapping[str, DataFrame]

WEEKLY_SERIES = ["disease_code", "disease_name"]
WEEKLY_LINE = ["disease_code", "disease_name", "county_name"]
WEEKLY_KEYS = [*WEEKLY_LINE, "iso_year", "iso_week", "week_start_date"]
MONTHLY_KEYS = ["county_name", "onset_year", "onset_month", "month_start"]


def known_counties(dim_geography: DataFrame) -> DataFrame:
    """`county_name` of the county level, the unknown one left out."""
    return dim_geography.where(
        (F.col("geo_level") == "county") & (F.col("county_name") != UNKNOWN_COUNTY[1])
    ).select("county_name")


def _county_names(tables: Tables) -> DataFrame:
    return tables["dim_geography"].select("geo_key", "county_name")


def weekly_sparse(tables: Tables) -> DataFrame:
    """Observed counts per disease, county and week; cases count where people live.

    The facts are first summed by their integer keys, before any name is looked up, so
    that only sums are joined and shuffled a second time.
    """
    visits = sparse_panel(
        tables["fact_nhi_visits"],
        ["disease_key", "geo_key", "date_key"],
        metric=F.col("visit_count"),
        denominator=F.col("total_visit_count"),
    )
    cases = sparse_panel(
        tables["fact_dengue_cases"].select(
            "disease_key",
            F.col("residence_geo_key").alias("geo_key"),
            F.col("onset_date_key").alias("date_key"),
            "case_count",
        ),
        ["disease_key", "geo_key", "date_key"],
        metric=F.col("case_count"),
    ).withColumn("denominator", F.lit(None).cast("bigint"))
    sums = visits.unionByName(cases)
    diseases = tables["dim_disease"].select("disease_key", *WEEKLY_SERIES)
    named = lookup(sums, diseases, ["disease_key"], small=True)
    # Should the names need a split join, it counts keys in the facts and not in the sums made again.
    places = tables["fact_nhi_visits"].select("geo_key").unionAll(
        tables["fact_dengue_cases"].select("residence_geo_key")
    )
    named = lookup(named, _county_names(tables), ["geo_key"], keys_of=places)
    monday = calendar.week_start(calendar.key_date(F.col("date_key")))
    by_week = sparse_panel(
        named.withColumn("week_start_date", monday),
        [*WEEKLY_LINE, "week_start_date"],
        metric=F.col("metric_value"),
        denominator=F.col("denominator"),
    )
    return _with_iso_week(by_week).select(*WEEKLY_KEYS, "metric_value", "denominator")


def _with_iso_week(panel: DataFrame) -> DataFrame:
    monday = F.col("week_start_date")
    return panel.withColumns(
        {"iso_year": calendar.iso_year(monday), "iso_week": calendar.iso_week(monday)}
    )


def weekly_dense(tables: Tables, cluster_by: Sequence[str] = tuple(WEEKLY_LINE)) -> DataFrame:
    """Every known county in every week its disease spans; the written layer, if the build has one."""
    return tables["weekly_dense"] if "weekly_dense" in tables else filled_weeks(tables, cluster_by)


def filled_weeks(tables: Tables, cluster_by: Sequence[str] = tuple(WEEKLY_LINE)) -> DataFrame:
    """`weekly_dense`, filled from the sums."""
    dense = densify(
        tables["agg_weekly"],
        known_counties(tables["dim_geography"]),
        series=WEEKLY_SERIES,
        entity="county_name",
        period="week_start_date",
        step=WEEK,
        metric="metric_value",
        denominator="denominator",
        cluster_by=cluster_by,
    )
    return _with_iso_week(dense).select(*WEEKLY_KEYS, "metric_value", "denominator")


def weekly_trend(tables: Tables) -> DataFrame:
    """Visit rate, 4- and 8-week means and week-over-week change."""
    with_trend = trend(
        weekly_dense(tables),
        line=WEEKLY_LINE,
        period="week_start_date",
        metric="metric_value",
        averages={"ma4": 4, "ma8": 8},
        previous="prev_week",
        change="wow_change",
        growth="wow_growth_pct",
    )
    return with_trend.withColumn("visit_rate", rate(F.col("metric_value"), F.col("denominator"))).select(
        *WEEKLY_KEYS, "metric_value", "visit_rate", "ma4", "ma8", "prev_week", "wow_change", "wow_growth_pct"
    )


def weekly_rank(tables: Tables) -> DataFrame:
    """Rank and share of each county per disease and week. A group is the counties of one week."""
    within = [*WEEKLY_SERIES, "week_start_date"]
    ranked = rank_and_share(
        weekly_dense(tables, cluster_by=within),
        within=within,
        metric="metric_value",
        rank="county_rank",
        share="pct_of_national",
    )
    return ranked.select(*WEEKLY_KEYS, "metric_value", "county_rank", "pct_of_national")


def monthly_sparse(tables: Tables) -> DataFrame:
    """Observed cases per county and month."""
    sums = sparse_panel(
        tables["fact_covid_cases"],
        ["geo_key", "onset_year", "onset_month"],
        metric=F.col("case_count"),
        names=("cases", ""),
    )
    named = lookup(sums, _county_names(tables), ["geo_key"], keys_of=tables["fact_covid_cases"].select("geo_key"))
    year, month = F.col("onset_year").cast("int"), F.col("onset_month").cast("int")
    months = named.select(
        "county_name",
        year.alias("onset_year"),
        month.alias("onset_month"),
        calendar.month_start(year, month).alias("month_start"),
        "cases",
    )
    return sparse_panel(months, MONTHLY_KEYS, metric=F.col("cases"), names=("cases", ""))


def monthly_dense(tables: Tables, cluster_by: Sequence[str] = ("county_name",)) -> DataFrame:
    """Every known county in every month from the first to the last observed one; the written layer, if
    the build has one."""
    return tables["monthly_dense"] if "monthly_dense" in tables else filled_months(tables, cluster_by)


def filled_months(tables: Tables, cluster_by: Sequence[str] = ("county_name",)) -> DataFrame:
    """`monthly_dense`, filled from the sums."""
    dense = densify(
        tables["agg_monthly"],
        known_counties(tables["dim_geography"]),
        series=[],
        entity="county_name",
        period="month_start",
        step=MONTH,
        metric="cases",
        cluster_by=cluster_by,
    )
    day = F.col("month_start")
    return dense.select(
        "county_name", F.year(day).alias("onset_year"), F.month(day).alias("onset_month"), day, "cases"
    )


def monthly_trend(tables: Tables) -> DataFrame:
    """3-month mean and month-over-month change."""
    return trend(
        monthly_dense(tables),
        line=["county_name"],
        period="month_start",
        metric="cases",
        averages={"ma3": 3},
        previous="prev_month",
        change="mom_change",
        growth="mom_growth_pct",
    )


def monthly_rank(tables: Tables) -> DataFrame:
    """Rank and share of each county per month."""
    return rank_and_share(
        monthly_dense(tables, cluster_by=["month_start"]),
        within=["month_start"],
        metric="cases",
        rank="county_rank",
        share="pct_of_national",
    )


VIEWS = {
    "weekly_dense": weekly_dense,
    "weekly_trend": weekly_trend,
    "weekly_rank": weekly_rank,
    "monthly_dense": monthly_dense,
    "monthly_trend": monthly_trend,
    "monthly_rank": monthly_rank,
}


def register_views(tables: Tables, more: Tables | None = None) -> None:
    """Name the tables and views for SQL, and the ISO weeks of the calendar. `more` are further
    tables, such as staged ones. They stay lazy; defining them again replaces them."""
    weeks = {"dim_iso_week": iso_weeks(tables["dim_date"].select("full_date"))}
    for name, table in {**tables, **weeks, **(more or {})}.items():
        table.createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        view(tables).createOrReplaceTempView(f"v_{name}")


def total(counts: Sequence[DataFrame], name: str) -> DataFrame:
    """Sum of the row counts of several tables."""
    stacked = None
    for df in counts:
        one = df.agg(F.count("*").alias("_n"))
        stacked = one if stacked is None else stacked.union(one)
    return stacked.agg(F.sum("_n").alias(name))


def maximum_of(df: DataFrame, column: str) -> Column:
    """The greatest value of a column as a scalar subquery, for use in a filter."""
    return df.agg(F.max(column)).scalar()
