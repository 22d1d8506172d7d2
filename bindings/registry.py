"""The registered queries: the library's plans on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings import feeds
from bindings import warehouse as bound
from bindings.feeds import table
from panelwatch.functions import calendar
from panelwatch.functions.measures import rate
from panelwatch.functions.sql import register_functions
from panelwatch.operators import checks, profile
from panelwatch.operators.lookup import lookup
from panelwatch.operators.panel import WEEK, densify, sparse_panel
from panelwatch.operators.pick import grid_density, sample_rows
from panelwatch.operators.trend import rank_and_share, trend
from panelwatch.plans import analytics, api, dimensions, quality, staging
from panelwatch.plans.schema import FACTS, columns
from panelwatch.plans.warehouse import build, staged_tables
from panelwatch.session import materialise, scratch_path
from panelwatch.sources.ingest import DATASETS, Source, exit_code, ingest
from panelwatch.sources.report import read_json, write_json
from panelwatch.sources.store import RawStore

Query = Callable[[SparkSession, str], DataFrame]

DISEASE, COUNTY = "DENGUE", "NATION_3"
RANK_WEEK = date(1998, 3, 2)
# Records of a CSV file, short ones and whole documents: 50 to 100 MB.
CSV_RECORDS, CSV_DOCUMENTS = 500_000, 20_000


# Panels straight on the tables.


def _orders_panel(spark: SparkSession, sf_dir: str, cluster_by: list[str]) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
    )
    orders = lookup(table(spark, sf_dir, "orders"), customers, ["o_custkey"])
    # Summed by key; only the sums are given names.
    sparse = sparse_panel(
        orders.withColumn("week_start_date", calendar.week_start(F.col("o_orderdate").cast("date"))),
        ["o_orderpriority", "n_nationkey", "week_start_date"],
        metric=F.when(F.col("o_orderstatus") == "F", 1).otherwise(0),
        denominator=F.lit(1),
    )
    named = lookup(sparse, nation.select("n_nationkey", "n_name"), ["n_nationkey"]).drop("n_nationkey")
    return densify(
        materialise(named, "orders_weekly"),
        nation,
        series=["o_orderpriority"],
        entity="n_name",
        period="week_start_date",
        step=WEEK,
        metric="metric_value",
        denominator="denominator",
        cluster_by=cluster_by,
    )


def orders_weekly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = ["o_orderpriority", "n_name"]
    monday = F.col("week_start_date")
    return trend(
        _orders_panel(spark, sf_dir, line),
        line=line,
        period="week_start_date",
        metric="metric_value",
        averages={"ma4": 4, "ma8": 8},
        previous="prev_week",
        change="wow_change",
        growth="wow_growth_pct",
    ).select(
        *line,
        calendar.iso_year(monday).alias("iso_year"),
        calendar.iso_week(monday).alias("iso_week"),
        monday,
        "metric_value",
        rate(F.col("metric_value"), F.col("denominator")).alias("visit_rate"),
        "ma4",
        "ma8",
        "prev_week",
        "wow_change",
        "wow_growth_pct",
    )


def orders_weekly_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    within = ["o_orderpriority", "week_start_date"]
    return rank_and_share(
        _orders_panel(spark, sf_dir, within),
        within=within,
        metric="metric_value",
        rank="nation_rank",
        share="pct_of_total",
    ).drop("denominator")


def orders_weekly_rank_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ranking by counts per value, the form for very many entities."""
    within = ["o_orderpriority", "week_start_date"]
    panel = _orders_panel(spark, sf_dir, within)
    ranked = rank_and_share(panel, within=within, metric="metric_value", rank="nation_rank", share="pct_of_total", wide=True)
    return ranked.select(*within, "n_name", "metric_value", "nation_rank", "pct_of_total")


def lines_split_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item with its part and supplier, by joins that spread hot keys whatever the sizes."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    named = lookup(lines, parts, ["l_partkey"], small=False)
    return lookup(named, suppliers, ["l_suppkey"], "left", small=False, keys_of=lines)


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar rows of the days that have orders."""
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("full_date"))
    return dimensions.calendar_dimension(spark, *feeds.CALENDAR).join(
        days.distinct(), "full_date", "left_semi"
    )


def order_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("full_date"))
    return dimensions.iso_weeks(days)


def _order_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a place; either coordinate may be missing."""
    segments = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    orders = lookup(table(spark, sf_dir, "orders"), segments, ["o_custkey"])

    def fraction(key: str) -> F.Column:
        return F.pmod(key, F.lit(1000)) / F.lit(1000.0)

    return orders.select(
        "o_orderkey",
        F.year("o_orderdate").alias("onset_year"),
        F.when(F.col("c_mktsegment") != "BUILDING", 22 + fraction("o_custkey")).alias("lat"),
        F.when(F.col("o_orderstatus") != "P", 120 + fraction("o_orderkey")).alias("lon"),
    ).where("lat IS NOT NULL AND lon IS NOT NULL")


def order_points_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_density(_order_points(spark, sf_dir), "lat", "lon", 2, ["onset_year"])


def order_points_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_rows(_order_points(spark, sf_dir), 5000, ["o_orderkey"])


# Ingestion: the derived sources written as CSV, then landed as a user's files are.


def csv_sources(spark: SparkSession, sf_dir: str, *roles: str) -> list[Source]:
    """The derived sources as CSV files; all of them if none is named."""
    raw = bound.sources(spark, sf_dir, *(roles or DATASETS))
    root = scratch_path(spark, "csv")
    sources = []
    for role, df in raw.items():
        name, disease = DATASETS[role]
        path = f"{root}/{name}"
        _to_csv(df, path)
        sources.append(Source(name, disease, path))
    return sources


def _ingest(spark: SparkSession, sf_dir: str, *roles: str) -> tuple[RawStore, DataFrame]:
    store = RawStore(scratch_path(spark, "store"))
    return store, ingest(spark, store, csv_sources(spark, sf_dir, *roles))


def ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, report = _ingest(spark, sf_dir, *DATASETS)
    return report.select("name", "disease", "rows", "cols")


def _ingested(role: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        store, _ = _ingest(spark, sf_dir, role)
        return store.latest(spark, DATASETS[role][0]).drop("_source_url", "_ingested_at")

    return query


def _to_csv(df: DataFrame, path: str, records: int = CSV_RECORDS) -> None:
    """CSV files of so many records at most; a file is parsed by one task, so none may grow with its table."""
    plain = {"emptyValue": "", "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.option("maxRecordsPerFile", records).csv(path, header=True, **plain)


def ingested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, written as CSV and landed: long texts with quotes and line breaks."""
    root = scratch_path(spark, "documents")
    _to_csv(table(spark, sf_dir, "documents"), f"{root}/files", CSV_DOCUMENTS)
    store = RawStore(f"{root}/store")
    report = ingest(spark, store, [Source("documents", "none", f"{root}/files")])
    if exit_code(report):
        raise RuntimeError(report.first()["error"])
    typed = {"doc_id": F.col("doc_id").cast("bigint"), "n_chars": F.col("n_chars").cast("bigint")}
    return store.latest(spark, "documents").drop("_source_url", "_ingested_at").withColumns(typed)


def _customer_store(spark: SparkSession, sf_dir: str) -> RawStore:
    """Two versions of the customers, the second with one column more and one less; no snapshot."""
    store = RawStore(scratch_path(spark, "versions"))
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")
    store.add(names.drop("c_mktsegment"), "customers", "v1")
    store.add(names.drop("c_name"), "customers", "v2")
    return store


def raw_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_store(spark, sf_dir).history(spark, "customers").select(
        "c_custkey", "c_name", "c_mktsegment", "ingest_ts"
    )


def newest_without_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_store(spark, sf_dir).latest(spark, "customers").select("c_custkey", "c_mktsegment")


def fallback_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations landed from a fallback; the lineage names the path that was read."""
    root = scratch_path(spark, "fallback")
    _to_csv(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), f"{root}/files")
    store = RawStore(f"{root}/store")
    report = ingest(spark, store, [Source("nations", "none", f"{root}/nowhere", f"{root}/files")])
    return store.latest(spark, "nations").select(
        F.col("n_nationkey").cast("int"),
        "n_name",
        F.substring_index("_source_url", "/", -1).alias("read_from"),
        report.select(F.col("primary_error").isNotNull()).scalar().alias("primary_failed"),
    )


def rebuilt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each fact that a second build has in other numbers than the first; none, so all zero."""
    first = bound.tables(spark, sf_dir)
    again = build(bound.landed(spark, sf_dir), scratch_path(spark, "rebuild"), feeds.CALENDAR, check=False)
    counts = []
    for fact in FACTS:
        kept = columns(fact)[1:]
        both = first[fact].select(*kept, F.lit(1).alias("_n")).unionAll(again[fact].select(*kept, F.lit(-1).alias("_n")))
        different = both.groupBy(*kept).agg(F.sum("_n").alias("_n")).where("_n != 0")
        counts.append(different.agg(F.lit(fact).alias("fact"), F.count("*").alias("different")))
    return checks.stack(counts)


# Plans on the warehouse.


def _staged(name: str) -> Query:
    return lambda spark, sf_dir: staged_tables(bound.landed(spark, sf_dir))[name]


def _wh(plan: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf_dir: plan(bound.tables(spark, sf_dir), *args)


def _written(name: str, skip_id: bool = False) -> Query:
    picked = columns(name)[1:] if skip_id else columns(name)
    return lambda spark, sf_dir: bound.tables(spark, sf_dir)[name].select(*picked)


def county_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.county_map(dimensions.counties(bound.source(spark, sf_dir, "flu")))


def rows_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = staged_tables(bound.landed(spark, sf_dir))
    return quality.rows_landed(staged, bound.tables(spark, sf_dir))


def line_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line asked for in SQL, with bound parameters."""
    analytics.register_views(bound.tables(spark, sf_dir))
    text = """
        SELECT week_start_date, metric_value, ma4, ma8, wow_growth_pct FROM v_weekly_trend
        WHERE disease_code = :disease AND county_name = :county ORDER BY week_start_date"""
    return spark.sql(text, args={"disease": "FLU", "county": COUNTY})


def onsets_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged cases per ISO week, in SQL over the named staging and calendar views."""
    raw = bound.landed(spark, sf_dir)
    more = {**staged_tables(raw), "county_map": dimensions.county_map(dimensions.counties(raw.flu))}
    analytics.register_views(bound.tables(spark, sf_dir), more)
    return spark.sql(
        """
        SELECT w.iso_year, w.iso_week, count(*) AS n_rows, count(county_code) AS n_mapped
        FROM stg_dengue JOIN dim_iso_week w ON w.week_start_date = CAST(date_trunc('week', onset_date) AS DATE)
        LEFT JOIN county_map ON county_name = res_county
        GROUP BY w.iso_year, w.iso_week"""
    )


def labels_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age and gender labels of the case list, cleaned by the SQL functions."""
    register_functions(spark)
    labels = bound.source(spark, sf_dir, "dengue").selectExpr(
        f"age_canon(`{staging.AGE}`) AS age_label", f"norm_gender(`{staging.GENDER}`) AS gender_code"
    )
    return labels.groupBy("age_label", "gender_code").agg(F.count("*").alias("n_rows"))


def flu_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = staging
    return profile.value_counts(bound.source(spark, sf_dir, "flu"), [s.VISIT_TYPE, s.VISIT_AGE, s.COUNTY, s.WEEK])


def covid_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = staging
    names = [s.GENDER, s.MONTHLY_IMPORTED, s.AGE, s.COUNTY, s.ONSET_MONTH]
    return profile.value_counts(bound.source(spark, sf_dir, "covid"), names)


def dengue_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = staging
    names = [s.GENDER, s.CASE_IMPORTED, s.AGE, s.HOME_COUNTY, s.SEROTYPE, s.CENTROID_X, s.CENTROID_Y]
    return profile.extent(bound.source(spark, sf_dir, "dengue"), names)


def dengue_extent_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values per column, exactly, and whether the estimate of merged sketches per year keeps its bound."""
    s = staging
    names = [s.GENDER, s.CASE_IMPORTED, s.AGE, s.HOME_COUNTY, s.SEROTYPE, s.CENTROID_X, s.CENTROID_Y, s.ONSET_DAY]
    cases = bound.source(spark, sf_dir, "dengue")
    years = F.substring(s.ONSET_DAY, 1, 4).alias("year")
    stored = materialise(profile.sketches(cases.select("*", years), names, ["year"]), "sketches")
    told = lookup(profile.extent(cases, names), profile.merged_estimates(stored, names), ["column_name"], small=True)
    error = F.abs(F.col("estimate") - F.col("n_distinct"))
    kept = error <= F.lit(profile.estimate_bound()) * F.col("n_distinct")
    return told.select("column_name", "n_distinct", kept.alias("within_bound"))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on a build, written as JSON and read again."""
    path = scratch_path(spark, "quality_report")
    staged = staged_tables(bound.landed(spark, sf_dir))
    write_json(quality.quality_report(staged, bound.tables(spark, sf_dir)), path)
    return read_json(spark, path, "section string, name string, value string")


def copied_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers' snapshot, in files of its own, after a newer version has come that is no snapshot."""
    store = _customer_store(spark, sf_dir)
    store.snapshot(spark, "customers", "v1", copy=True)
    own = F.contains(F.col("_metadata.file_path"), F.lit("/snapshot/customers/v1/"))
    return store.latest(spark, "customers").select("c_custkey", "c_name", own.alias("in_copy"))


def onset_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.length_histogram(bound.source(spark, sf_dir, "dengue"), staging.ONSET_DAY)


def shortest_onsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.shortest_values(bound.source(spark, sf_dir, "dengue"), staging.ONSET_DAY, 10, 10)


def county_name_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bound.sources(spark, sf_dir, "flu", "covid", "dengue")
    tables = {
        "flu": (raw["flu"], staging.COUNTY),
        "covid": (raw["covid"], staging.COUNTY),
        "dengue": (raw["dengue"], staging.HOME_COUNTY),
    }
    return profile.values_containing(tables, "%_2_")


def county_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bound.sources(spark, sf_dir, "flu", "covid", "dengue")
    parts = [(raw["flu"], staging.COUNTY), (raw["covid"], staging.COUNTY), (raw["dengue"], staging.HOME_COUNTY)]
    return profile.distinct_union(parts, "county_name")


QUERIES: dict[str, Query] = {
    "orders_weekly_trend": orders_weekly_trend,
    "orders_weekly_rank": orders_weekly_rank,
    "orders_weekly_rank_wide": orders_weekly_rank_wide,
    "lines_split_join": lines_split_join,
    "order_days": order_days,
    "order_weeks": order_weeks,
    "order_points_grid": order_points_grid,
    "order_points_sample": order_points_sample,
    "ingested_flu": _ingested("flu"),
    "ingested_dengue": _ingested("dengue"),
    "ingest_report": ingest_report,
    "ingested_documents": ingested_documents,
    "raw_history": raw_history,
    "newest_without_snapshot": newest_without_snapshot,
    "fallback_lineage": fallback_lineage,
    "rebuilt_rows": rebuilt_rows,
    "stg_nhi": _staged("stg_nhi"),
    "stg_covid": _staged("stg_covid"),
    "stg_dengue": _staged("stg_dengue"),
    "county_map": county_map,
    "dim_age_group": _written("dim_age_group"),
    "dim_geography": _written("dim_geography"),
    **{fact: _written(fact, skip_id=True) for fact in FACTS},
    "agg_weekly": _wh(analytics.weekly_sparse),
    "weekly_dense": _wh(analytics.weekly_dense),
    "weekly_trend": _wh(analytics.weekly_trend),
    "weekly_rank": _wh(analytics.weekly_rank),
    "agg_monthly": _wh(analytics.monthly_sparse),
    "monthly_dense": _wh(analytics.monthly_dense),
    "monthly_trend": _wh(analytics.monthly_trend),
    "monthly_rank": _wh(analytics.monthly_rank),
    "observed_diseases": _wh(api.observed_diseases),
    "counties": _wh(api.counties),
    "county_count": _wh(api.county_count),
    "trend_line": _wh(api.weekly_trend, DISEASE, COUNTY),
    "line_by_sql": line_by_sql,
    "kpis": _wh(api.weekly_kpis, DISEASE, COUNTY),
    "kpis_of_no_line": _wh(api.weekly_kpis, DISEASE, "NOWHERE"),
    "disease_weeks": _wh(api.weekly_weeks, "FLU"),
    "rank_in_week": _wh(api.county_rank_week, "EV", RANK_WEEK),
    "month_line": _wh(api.covid_trend, "NATION_7"),
    "points": _wh(api.dengue_points),
    "points_of_year": _wh(api.dengue_points, 1998),
    "point_years": _wh(api.dengue_years),
    "point_top_year": _wh(api.dengue_top_year),
    "point_density": _wh(api.map_density, None, 1),
    "point_sample": _wh(api.map_points, 1998, 100),
    "fact_total": _wh(api.fact_total),
    "onset_span": _wh(api.onset_span),
    "peak_year": _wh(api.peak_year, DISEASE, COUNTY),
    "peak_month": _wh(api.peak_month),
    "peak_week_ranking": _wh(api.peak_week_ranking, DISEASE, 1998),
    "curve": _wh(api.curve, DISEASE, COUNTY, 1999, (34, 44)),
    "top_counties_in_week": _wh(api.top_counties_in_week, DISEASE, 1999, 40),
    "steepest_months": _wh(api.steepest_months),
    "top_counties_latest_month": _wh(api.top_counties_latest_month),
    "rank_bars": _wh(api.rank_bars, "FLU", RANK_WEEK, COUNTY),
    "growth_bars": _wh(api.growth_bars, DISEASE, COUNTY),
    "unique_constraints": _wh(quality.unique_constraints),
    "not_null_constraints": _wh(quality.not_null_constraints),
    "reference_constraints": _wh(quality.reference_constraints),
    "rows_landed": rows_landed,
    "plausible_measures": _wh(quality.plausible_measures),
    "row_counts": _wh(quality.row_counts),
    "geography_sizes": _wh(quality.geography_sizes),
    "geocoded_share": _wh(quality.geocoded_share),
    "top_counties_by_visits": _wh(quality.top_counties_by_visits, "FLU"),
    "sparse_and_dense_rows": _wh(quality.sparse_and_dense_rows),
    "recomputed_mean": _wh(quality.recomputed_mean, "FLU", COUNTY, 1999),
    "labels_by_sql": labels_by_sql,
    "onsets_by_sql": onsets_by_sql,
    "flu_values": flu_values,
    "covid_values": covid_values,
    "dengue_extent": dengue_extent,
    "dengue_extent_sketched": dengue_extent_sketched,
    "quality_report": quality_report,
    "copied_snapshot": copied_snapshot,
    "onset_lengths": onset_lengths,
    "shortest_onsets": shortest_onsets,
    "county_name_variants": county_name_variants,
    "county_names": county_names,
}
