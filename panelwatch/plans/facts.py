"""Facts: staged rows with dimension keys.

The dimensions are written tables whose sizes are checked, so loading is one pass over
the source without a shuffle; only a dimension too large to broadcast brings one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.functions import calendar
from panelwatch.functions.clean import blank_to_null, is_blank, strict_cast
from panelwatch.operators.lookup import fits_broadcast, lookup
from panelwatch.plans.schema import UNKNOWN_COUNTY, columns

ROW_ID = "_row_id"


class Dimensions(dict[str, DataFrame]):
    """Written dimension tables, whose rows are counted once and not at every lookup."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        super().__init__(tables)
        self._small: dict[str, bool] = {}

    def small(self, name: str) -> bool:
        if name not in self._small:
            self._small[name] = fits_broadcast(self[name])
        return self._small[name]


def _counted(dims: Mapping[str, DataFrame]) -> Dimensions:
    return dims if isinstance(dims, Dimensions) else Dimensions(dims)


def _numbered(staged: DataFrame) -> DataFrame:
    """Rows with an id that is made at the scan, below all joins: a task that runs again reads its
    rows in the same order, so it makes the same ids."""
    return staged.withColumn(ROW_ID, F.monotonically_increasing_id())


def _attach(
    rows: DataFrame, staged: DataFrame, dims: Dimensions, dim: str, names: dict[str, str], how: str = "inner"
) -> DataFrame:
    """Look up a dimension's key by its natural key; `names` are the names both get here.

    Diseases and genders are fixed seeds, the others have their size checked. Hot keys
    are counted in the staged rows, not behind the lookups made before.
    """
    *natural, _ = names.values()
    seeded = dim in ("dim_disease", "dim_gender")
    table = dims[dim].select(*[F.col(column).alias(name) for column, name in names.items()])
    small = True if seeded else dims.small(dim)
    return lookup(rows, table, natural, how, small=small, keys_of=staged, salt_by=[ROW_ID])


def _with_codes(staged: DataFrame, dims: Dimensions, disease: str | None = None) -> DataFrame:
    """Look up the codes a source has. A source of one `disease` has no column for it, but
    for the gender: its key is a scalar subquery rather than a join with one row."""

    def same(*names: str) -> dict[str, str]:
        return dict(zip(names, names))

    keyed = _attach(staged, staged, dims, "dim_age_group", same("age_label", "age_key"))
    if disease is None:
        return _attach(keyed, staged, dims, "dim_disease", same("disease_code", "disease_key"))
    keyed = _attach(keyed, staged, dims, "dim_gender", same("gender_code", "gender_key"))
    one = dims["dim_disease"].where(F.col("disease_code") == disease).select("disease_key")
    return keyed.withColumn("disease_key", one.scalar())


def _with_place(
    rows: DataFrame, staged: DataFrame, dims: Dimensions, county: str, town: str, key: str, how: str = "inner"
) -> DataFrame:
    """The geography in one of its roles."""
    names = {"county_name": county, "town_name": town, "geo_key": key}
    return _attach(rows, staged, dims, "dim_geography", names, how)


def load_nhi(staged: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Weekly visits at the Monday of their ISO week. Year and week stay as the source
    gives them, also where a week 53 belongs to the next year."""
    dims = _counted(dims)
    county_level = _numbered(staged).withColumn("town_name", F.lit(""))
    coded = _with_codes(county_level, dims)
    keyed = _with_place(coded, county_level, dims, "county_name", "town_name", "geo_key")
    year = strict_cast(F.col("iso_year"), "int")
    week = strict_cast(F.col("iso_week"), "int")
    return keyed.select(
        F.col(ROW_ID).alias("visit_id"),
        calendar.date_key(calendar.iso_week_monday(year, week)).alias("date_key"),
        "geo_key",
        "disease_key",
        "age_key",
        "visit_type",
        F.lit("WEEKLY").alias("period_type"),
        strict_cast(F.col("iso_year"), "smallint").alias("iso_year"),
        strict_cast(F.col("iso_week"), "tinyint").alias("iso_week"),
        "visit_count",
        "total_visit_count",
    )


def load_covid(staged: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Monthly counts at the first day of their month."""
    dims, numbered = _counted(dims), _numbered(staged)
    coded = _with_codes(numbered, dims, "19CoV")
    keyed = _with_place(coded, numbered, dims, "county_name", "town_name", "geo_key")
    return keyed.select(
        F.col(ROW_ID).alias("covid_id"),
        calendar.month_key(F.col("onset_year"), F.col("onset_month")).alias("date_key"),
        "geo_key",
        "disease_key",
        "age_key",
        "gender_key",
        F.lit("MONTHLY").alias("period_type"),
        strict_cast(F.col("onset_year"), "smallint").alias("onset_year"),
        strict_cast(F.col("onset_month"), "tinyint").alias("onset_month"),
        "is_imported",
        "case_count",
    )


def load_dengue(staged: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Cases at their onset day, with the geography in two roles.

    A case without a county of residence belongs to the unknown county. The place of
    infection may be missing or not in the geography; its key is then NULL.
    """
    dims = _counted(dims)
    homeless = is_blank(F.col("res_county"))
    prepared = _numbered(staged).withColumns(
        {
            "res_town": F.when(homeless, F.lit("")).otherwise(F.col("res_town")),
            "res_county": F.when(homeless, F.lit(UNKNOWN_COUNTY[1])).otherwise(F.col("res_county")),
            "inf_county": blank_to_null(F.col("inf_county")),
        }
    )
    coded = _with_codes(prepared, dims, "DENGUE")
    keyed = _with_place(coded, prepared, dims, "res_county", "res_town", "residence_geo_key")
    keyed = _with_place(keyed, prepared, dims, "inf_county", "inf_town", "infection_geo_key", "left")
    return keyed.select(
        F.col(ROW_ID).alias("dengue_case_id"),
        calendar.date_key(F.col("onset_date")).alias("onset_date_key"),
        calendar.date_key(F.col("determined_date")).alias("determined_date_key"),
        calendar.date_key(F.col("reported_date")).alias("reported_date_key"),
        *[
            c
            for c in columns("fact_dengue_cases")
            if c not in ("dengue_case_id", "onset_year") and not c.endswith("date_key")
        ],
        F.year("onset_date").cast("smallint").alias("onset_year"),
    )
