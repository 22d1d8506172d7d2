"""Checks of a build: constraints, landed rows, plausible measures, sanity figures."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwatch.functions.measures import percent, round_half_away
from panelwatch.operators import checks
from panelwatch.operators.pick import top_groups
from panelwatch.plans import analytics
from panelwatch.plans.schema import DIMENSIONS, FACTS, NULLABLE, PARTITIONED_BY, REFERENCES, UNIQUE, columns

Tables = Mapping[str, DataFrame]

STAGED_FOR = {
    "fact_nhi_visits": "stg_nhi",
    "fact_covid_cases": "stg_covid",
    "fact_dengue_cases": "stg_dengue",
}


def unique_constraints(tables: Tables, names=DIMENSIONS + FACTS) -> DataFrame:
    return checks.duplicate_keys(
        [(f"{t}({', '.join(key)}) unique", tables[t], key) for t in names for key in UNIQUE[t]]
    )


def _not_null(table: str) -> list[dict[str, str]]:
    """Conditions of a table's required columns, those of its partitions apart: files have statistics of all others."""
    required = [c for c in columns(table) if c not in NULLABLE.get(table, ())]
    partition = [c for c in required if c == PARTITIONED_BY.get(table)]
    kept = [c for c in required if c not in partition]
    return [checks.not_null(table, names) for names in (kept, partition) if names]


def not_null_constraints(tables: Tables, names=DIMENSIONS + FACTS) -> DataFrame:
    return checks.stack([checks.counted(tables[t], conditions) for t in names for conditions in _not_null(t)])


def reference_constraints(tables: Tables) -> DataFrame:
    return checks.missing_references(tables, REFERENCES)


def rows_landed(staged: Tables, tables: Tables) -> DataFrame:
    """`check, ok`: every staged row is in its fact table."""

    def signed(df: DataFrame, fact: str, sign: int) -> DataFrame:
        return df.agg(F.lit(fact).alias("fact"), (F.count("*") * sign).alias("n"))

    counts = [signed(staged[stage], fact, 1) for fact, stage in STAGED_FOR.items()]
    counts += [signed(tables[fact], fact, -1) for fact in STAGED_FOR]
    difference = checks.stack(counts).groupBy("fact").agg(F.sum("n").alias("d"))
    return difference.select(
        F.concat("fact", F.lit(" rows landed")).alias("check"), (F.col("d") == 0).alias("ok")
    )


def plausible_measures(tables: Tables) -> DataFrame:
    """`check, ok`: no negative visits, and some cases with coordinates."""
    # Filters, which the statistics of files answer where no row can meet them.
    visits = tables["fact_nhi_visits"].where(F.col("visit_count") < 0).agg(F.count("*").alias("n"))
    located = tables["fact_dengue_cases"].where(F.col("centroid_x").isNotNull()).agg(F.count("*").alias("n"))
    return visits.select(F.lit("no negative visit_count").alias("check"), (F.col("n") == 0).alias("ok")).union(
        located.select(F.lit("some cases geocoded"), F.col("n") > 0)
    )


def _as_checks(constraints: DataFrame) -> DataFrame:
    return constraints.select(
        F.col("constraint").alias("check"), (F.col("violations") == 0).alias("ok")
    )


def build_reports(staged: Tables, tables: Tables) -> dict[str, Callable[[], DataFrame]]:
    """`check, ok` for everything a build must satisfy, as reports that can run side by side."""
    return {
        "landed": lambda: rows_landed(staged, tables),
        "measures": lambda: plausible_measures(tables),
        "unique": lambda: _as_checks(unique_constraints(tables)),
        "not null": lambda: _as_checks(not_null_constraints(tables)),
        "references": lambda: _as_checks(reference_constraints(tables)),
    }


def build_report(staged: Tables, tables: Tables) -> DataFrame:
    """All of them in one table."""
    return checks.stack([report() for report in build_reports(staged, tables).values()])


def quality_report(staged: Tables, tables: Tables) -> DataFrame:
    """`section, name, value` as text: every check of a build, the rows of every table, and what each disease sums up to."""
    checked = build_report(staged, tables).select(
        F.lit("check").alias("section"), F.col("check").alias("name"), F.col("ok").cast("string").alias("value")
    )
    rows = row_counts(tables).select(F.lit("rows").alias("section"), F.col("table_name").alias("name"), F.col("n_rows").cast("string").alias("value"))
    sums = tables["agg_weekly"].groupBy("disease_name").agg(F.sum("metric_value").alias("n"))
    diseases = sums.select(F.lit("disease").alias("section"), F.col("disease_name").alias("name"), F.col("n").cast("string").alias("value"))
    return checks.stack([checked, rows, diseases])


def row_counts(tables: Tables, names=DIMENSIONS + FACTS) -> DataFrame:
    return checks.stack(
        [tables[t].agg(F.lit(t).alias("table_name"), F.count("*").alias("n_rows")) for t in names]
    )


def geography_sizes(tables: Tables) -> DataFrame:
    level = F.col("geo_level")
    return tables["dim_geography"].agg(
        F.count_if(level == "county").alias("counties"), F.count_if(level == "town").alias("towns")
    )


def geocoded_share(tables: Tables) -> DataFrame:
    located = F.count_if(F.col("centroid_x").isNotNull())
    return tables["fact_dengue_cases"].agg(percent(located, F.count("*")).alias("geocoded_pct"))


def top_counties_by_visits(tables: Tables, disease: str, k: int = 3) -> DataFrame:
    """`county_name, visits`, from the weekly sums."""
    of_disease = tables["agg_weekly"].where(F.col("disease_code") == disease)
    return top_groups(of_disease, ["county_name"], F.sum("metric_value"), "visits", k)


def sparse_and_dense_rows(tables: Tables) -> DataFrame:
    sparse = tables["agg_weekly"].agg(F.lit("sparse").alias("layer"), F.count("*").alias("n_rows"))
    dense = analytics.weekly_dense(tables).agg(F.lit("dense"), F.count("*"))
    return sparse.union(dense)


def recomputed_mean(tables: Tables, disease: str, county: str, year: int) -> DataFrame:
    """`n_rows, matching`: the 4-week mean against one computed from the year's rows alone.
    The first three weeks of the year may differ, as they lack their predecessors."""
    one = analytics.weekly_trend(tables).where(
        (F.col("disease_code") == disease) & (F.col("county_name") == county) & (F.col("iso_year") == year)
    )
    frame = Window.partitionBy("disease_code", "county_name").orderBy("week_start_date").rowsBetween(-3, 0)
    again = one.withColumn("_mean", F.avg("metric_value").over(frame))
    same = F.col("ma4") == round_half_away(F.col("_mean"), 1)
    return again.agg(
        F.count("*").alias("n_rows"), F.sum(F.when(same, 1).otherwise(0)).alias("matching")
    )
