"""Questions a dashboard or an export asks of a warehouse. All return DataFrames."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.functions.measures import direction
from panelwatch.operators.pick import grid_density, latest, peak, sample_rows, top_groups
from panelwatch.plans import analytics
from panelwatch.plans.analytics import known_counties, maximum_of, total
from panelwatch.plans.schema import FACTS

Tables = Mapping[str, DataFrame]

BARS = 15


def diseases(tables: Tables) -> DataFrame:
    return tables["dim_disease"].orderBy("disease_key").select("disease_code", "disease_name")


def observed_diseases(tables: Tables) -> DataFrame:
    """The diseases that have facts."""
    keys = [tables[fact].select("disease_key").distinct() for fact in FACTS]
    seen = keys[0].union(keys[1]).union(keys[2])
    return diseases({"dim_disease": tables["dim_disease"].join(seen, "disease_key", "left_semi")})


def counties(tables: Tables) -> DataFrame:
    return known_counties(tables["dim_geography"]).orderBy("county_name")


def county_count(tables: Tables) -> DataFrame:
    return known_counties(tables["dim_geography"]).agg(F.count("*").alias("counties"))


def _weekly_line(tables: Tables, disease: str, county: str) -> DataFrame:
    return analytics.weekly_trend(tables).where(
        (F.col("disease_code") == disease) & (F.col("county_name") == county)
    )


def weekly_trend(tables: Tables, disease: str, county: str) -> DataFrame:
    line = _weekly_line(tables, disease, county).orderBy("week_start_date")
    return line.select("week_start_date", "metric_value", "ma4", "ma8", "wow_growth_pct")


def weekly_kpis(tables: Tables, disease: str, county: str) -> DataFrame:
    """Always one row; all NULL for a line that does not exist."""
    week, metric = "week_start_date", "metric_value"
    return _weekly_line(tables, disease, county).agg(
        latest(metric, week).alias("latest_value"),
        F.max(week).alias("latest_week"),
        latest("wow_growth_pct", week).alias("latest_wow"),
        latest("ma4", week).alias("latest_ma4"),
        F.max(metric).alias("peak_value"),
        peak(week, metric, week).alias("peak_week"),
        F.sum(metric).alias("total_value"),
    )


def weekly_weeks(tables: Tables, disease: str) -> DataFrame:
    """The weeks a disease spans. They are those of its dense panel, without building it."""
    week = "week_start_date"
    observed = tables["agg_weekly"].where(F.col("disease_code") == disease)
    span = observed.agg(F.sequence(F.min(week), F.max(week), F.expr("interval 7 days")).alias("weeks"))
    return span.select(F.explode("weeks").alias(week)).orderBy(week)


def county_rank_week(tables: Tables, disease: str, week: date) -> DataFrame:
    ranked = analytics.weekly_rank(tables).where(
        (F.col("disease_code") == disease) & (F.col("week_start_date") == F.lit(week))
    )
    return ranked.orderBy("county_rank", "county_name").select(
        "county_name", "metric_value", "county_rank", "pct_of_national"
    )


def covid_trend(tables: Tables, county: str) -> DataFrame:
    line = analytics.monthly_trend(tables).where(F.col("county_name") == county)
    return line.orderBy("month_start").select("month_start", "cases", "ma3", "mom_growth_pct")


def dengue_points(tables: Tables, year: int | None = None) -> DataFrame:
    """Cases with both coordinates. A year reads only its partition."""
    located = tables["fact_dengue_cases"].where("centroid_x IS NOT NULL AND centroid_y IS NOT NULL")
    if year is not None:
        located = located.where(F.col("onset_year") == year)
    return located.select(
        F.col("centroid_y").alias("lat"), F.col("centroid_x").alias("lon"), "onset_year"
    )


def _with_longitude(tables: Tables) -> DataFrame:
    return tables["fact_dengue_cases"].where("centroid_x IS NOT NULL")


def dengue_years(tables: Tables) -> DataFrame:
    return _with_longitude(tables).select("onset_year").distinct().orderBy("onset_year")


def dengue_top_year(tables: Tables) -> DataFrame:
    """`onset_year, n_cases` with the most located cases; of equal years the first."""
    return top_groups(_with_longitude(tables), ["onset_year"], F.count("*"), "n_cases")


def map_points(tables: Tables, year: int, cap: int, seed: int = 0) -> DataFrame:
    """`cap` points of a year, or all if a map can draw them (`map_density` shows all in any case).

    A point is told by its place and day, and by a number among equal ones, which are counted and
    not gathered. So a rebuilt warehouse gives the same sample.
    """
    located = tables["fact_dengue_cases"].where(
        (F.col("onset_year") == year) & F.col("centroid_x").isNotNull() & F.col("centroid_y").isNotNull()
    )
    point = ["lat", "lon", "onset_date_key"]
    counted = (
        located.select(F.col("centroid_y").alias("lat"), F.col("centroid_x").alias("lon"), "onset_date_key")
        .groupBy(*point)
        .agg(F.count("*").alias("n"))
    )
    points = counted.select(*point, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("occurrence"))
    return sample_rows(points, cap, [*point, "occurrence"], seed).select("lat", "lon")


def map_density(tables: Tables, year: int | None = None, digits: int = 2) -> DataFrame:
    """The whole point set as counts per grid cell."""
    return grid_density(dengue_points(tables, year), "lat", "lon", digits)


def fact_total(tables: Tables) -> DataFrame:
    return total([tables[fact] for fact in FACTS], "facts")


def onset_span(tables: Tables) -> DataFrame:
    """First and last calendar day with an onset, and the difference of their years."""
    onsets = tables["fact_dengue_cases"].select(F.col("onset_date_key").alias("date_key"))
    days = tables["dim_date"].join(onsets.distinct(), "date_key", "left_semi")
    span = days.agg(F.min("full_date").alias("first_onset"), F.max("full_date").alias("last_onset"))
    return span.withColumn("years", F.year("last_onset") - F.year("first_onset"))


def peak_year(tables: Tables, disease: str, county: str) -> DataFrame:
    """The year of the greatest weekly value of one line."""
    return top_groups(
        _weekly_line(tables, disease, county), ["iso_year"], F.max("metric_value"), "peak_value"
    )


def peak_month(tables: Tables) -> DataFrame:
    """The month with the most cases over all counties."""
    # Months without cases add nothing to a sum, so the sparse ones will do; known counties may have none at all.
    sparse, span = tables["agg_monthly"], F.sequence(F.min("month_start"), F.max("month_start"), F.expr("interval 1 month"))
    months = sparse.agg(span.alias("months")).select(F.explode("months").alias("month_start"))
    sums = _sums_with_empty(_of_known(tables, sparse), months, "month_start", "cases")
    day = F.col("month_start")
    parted = sums.select(F.year(day).alias("onset_year"), F.month(day).alias("onset_month"), "cases")
    return top_groups(parted, ["onset_year", "onset_month"], F.sum("cases"), "total_cases")


def _of_known(tables: Tables, sparse: DataFrame) -> DataFrame:
    return sparse.join(known_counties(tables["dim_geography"]), "county_name", "left_semi")


def _sums_with_empty(sparse: DataFrame, periods: DataFrame, period: str, metric: str) -> DataFrame:
    """Observations, and a zero for every period of the span."""
    return sparse.select(period, metric).unionByName(periods.select(period, F.lit(0).cast("bigint").alias(metric)))


def peak_week(tables: Tables, disease: str, year: int) -> DataFrame:
    """The week of a calendar year with the greatest sum over counties; the first of equals."""
    week, metric = "week_start_date", "metric_value"
    observed = _of_known(tables, tables["agg_weekly"].where(F.col("disease_code") == disease))
    weeks = _sums_with_empty(observed, weekly_weeks(tables, disease), week, metric).where(F.year(week) == year)
    return top_groups(weeks, ["week_start_date"], F.sum("metric_value"), "total_value")


def peak_week_ranking(tables: Tables, disease: str, year: int) -> DataFrame:
    """The ranking in that week, found and ranked in one job."""
    top = peak_week(tables, disease, year).select("week_start_date").scalar()
    ranked = analytics.weekly_rank(tables).where(
        (F.col("disease_code") == disease) & (F.col("week_start_date") == top)
    )
    return ranked.orderBy("county_rank", "county_name").select(
        "week_start_date", "county_name", "metric_value", "county_rank", "pct_of_national"
    )


def curve(tables: Tables, disease: str, county: str, year: int, weeks: tuple[int, int]) -> DataFrame:
    """Part of a line, by ISO weeks of one ISO year."""
    part = _weekly_line(tables, disease, county).where(
        (F.col("iso_year") == year) & F.col("iso_week").between(*weeks)
    )
    return part.orderBy("iso_week").select(
        "iso_week", F.col("metric_value").alias("cases"), "ma4", "wow_growth_pct"
    )


def top_counties_in_week(tables: Tables, disease: str, year: int, week: int, k: int = 5) -> DataFrame:
    ranked = analytics.weekly_rank(tables).where(
        (F.col("disease_code") == disease) & (F.col("iso_year") == year) & (F.col("iso_week") == week)
    )
    return ranked.orderBy("county_rank", "county_name").limit(k).select(
        "county_name", F.col("metric_value").alias("cases"), "county_rank", "pct_of_national"
    )


def steepest_months(tables: Tables, base: int = 100, k: int = 5) -> DataFrame:
    """The greatest monthly growth where the month before had at least `base` cases."""
    grown = analytics.monthly_trend(tables).where(F.col("prev_month") >= base)
    order = [F.col("mom_growth_pct").desc_nulls_last(), F.col("month_start"), F.col("county_name")]
    return grown.orderBy(*order).limit(k).select("county_name", "month_start", "cases", "ma3", "mom_growth_pct")


def top_counties_latest_month(tables: Tables, k: int = 5) -> DataFrame:
    # The last dense month is the last observed one.
    last = maximum_of(tables["agg_monthly"], "month_start")
    ranked = analytics.monthly_rank(tables).where(F.col("month_start") == last)
    return ranked.orderBy("county_rank", "county_name").limit(k).select(
        "county_name", "cases", "county_rank", "pct_of_national"
    )


def rank_bars(tables: Tables, disease: str, week: date, selected: str, n: int = BARS) -> DataFrame:
    """The first bars of a ranking, with the selected county marked."""
    ranking = county_rank_week(tables, disease, week).limit(n)
    return ranking.withColumn("selected", F.col("county_name") == F.lit(selected))


def growth_bars(tables: Tables, disease: str, county: str) -> DataFrame:
    """Weekly growth where it is defined, up or down."""
    growth = weekly_trend(tables, disease, county).dropna(subset=["wow_growth_pct"])
    return growth.select(
        "week_start_date", "wow_growth_pct", direction(F.col("wow_growth_pct")).alias("direction")
    )


