"""Conformed dimensions: seeds, calendar, age bands, geography."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.functions import calendar, clean
from panelwatch.operators.keys import number_rows
from panelwatch.operators.lookup import lookup
from panelwatch.plans import staging as raw_columns
from panelwatch.plans.schema import CALENDAR, DISEASES, GENDERS, TABLES, UNKNOWN_COUNTY


@dataclass(frozen=True)
class RawTables:
    """The four sources, as untyped text."""

    flu: DataFrame
    ev: DataFrame
    covid: DataFrame
    dengue: DataFrame


def disease_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DISEASES), TABLES["dim_disease"])


def gender_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(GENDERS), TABLES["dim_gender"])


def day_series(spark: SparkSession, first: str, last: str) -> DataFrame:
    """`full_date`: every day from `first` to `last`, both included."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("full_date"))


def date_dimension(days: DataFrame) -> DataFrame:
    """The calendar attributes of a column `full_date`."""
    day = F.col("full_date")
    day_of_month = F.dayofmonth(day)
    day_of_week = F.weekday(day) + 1
    return days.select(
        calendar.date_key(day).alias("date_key"),
        day,
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("tinyint").alias("quarter"),
        F.month(day).cast("tinyint").alias("month"),
        day_of_month.cast("tinyint").alias("day"),
        calendar.iso_year(day).cast("smallint").alias("iso_year"),
        calendar.iso_week(day).cast("tinyint").alias("iso_week"),
        day_of_week.cast("tinyint").alias("day_of_week"),
        (day_of_month == 1).alias("is_month_start"),
        (day_of_week == 1).alias("is_iso_week_start"),
    )


def calendar_dimension(spark: SparkSession, first: str = CALENDAR[0], last: str = CALENDAR[1]) -> DataFrame:
    return date_dimension(day_series(spark, first, last))


def iso_weeks(dim_date: DataFrame) -> DataFrame:
    """The Mondays of all weeks the calendar touches; the first may lie before it."""
    day = F.col("full_date")
    return dim_date.select(
        calendar.iso_year(day).alias("iso_year"),
        calendar.iso_week(day).alias("iso_week"),
        calendar.week_start(day).alias("week_start_date"),
    ).distinct()


def members(raw: RawTables) -> DataFrame:
    """The distinct places and age labels that the sources mention.

    Each source is read once and reduced before the shuffle; ages and all kinds of
    places come out of the same pass, of the distinct combinations of their texts, so that
    no row of a source is cleaned or repeated. `kind` is `age`, `county` or `town`.
    """

    def age(column: str):
        label = clean.age_canon(F.col(column))
        return _member("age", name=label)

    def town(county: str, name: str, code=F.lit("")):
        return _member("town", county=F.col(county), name=F.col(name), code=code)

    def found(df: DataFrame, texts: list[str], *kinds) -> DataFrame:
        return df.select(*texts).distinct().select(F.inline(F.array(*kinds)))

    c = raw_columns
    homes, infections = [c.HOME_COUNTY, c.HOME_TOWN], [c.INFECTION_COUNTY, c.INFECTION_TOWN]
    stacked = (
        found(raw.flu, [c.VISIT_AGE, c.COUNTY, c.COUNTY_CODE], age(c.VISIT_AGE), _county())
        .union(found(raw.ev, [c.VISIT_AGE], age(c.VISIT_AGE)))
        .union(found(raw.covid, [c.AGE, c.COUNTY, c.TOWN, c.TOWN_CODE], age(c.AGE), town(c.COUNTY, c.TOWN, F.col(c.TOWN_CODE))))
        .union(found(raw.dengue, [c.AGE, *homes, *infections], age(c.AGE), town(*homes), town(*infections)))
    )
    return stacked.distinct()


def _member(kind: str, *, county=None, name=None, code=None):
    empty = F.lit("")
    return F.struct(
        F.lit(kind).alias("kind"),
        (empty if county is None else county).alias("county"),
        (empty if name is None else name).alias("name"),
        (empty if code is None else code).alias("code"),
    )


def _county():
    return _member("county", county=F.col(raw_columns.COUNTY), code=F.col(raw_columns.COUNTY_CODE))


def counties(flu: DataFrame) -> DataFrame:
    """Those `members` of which `county_map` is made; one source has them all."""
    return flu.select(raw_columns.COUNTY, raw_columns.COUNTY_CODE).distinct().select(F.inline(F.array(_county())))


def county_map(members: DataFrame) -> DataFrame:
    return members.where("kind = 'county'").select(
        F.col("code").alias("county_code"), F.col("county").alias("county_name")
    )


def age_dimension(members: DataFrame, *, small: bool | None = None) -> DataFrame:
    """Age labels with their bounds. `small` tells that the members are proven few."""
    labels = members.where("kind = 'age'").select(F.col("name").alias("age_label"))
    lower, upper = clean.age_bounds(F.col("age_label"))
    banded = labels.select("age_label", lower.alias("age_lower"), upper.alias("age_upper"))
    return number_rows(banded, ["age_label"], "age_key", "int", small=small)


def geography_dimension(members: DataFrame, *, small: bool | None = None) -> DataFrame:
    """Counties, the unknown county and towns, conformed by name.

    A county has the empty town name. Towns exist only below a known county. Among the
    codes given for a town the greatest one is kept, so a code wins over none.
    """
    counties = county_map(members)
    empty = F.lit("")
    town_rows = members.where("kind = 'town' AND name <> '' AND county <> ''").groupBy(
        F.col("county").alias("county_name"), F.col("name").alias("town_name")
    ).agg(F.max("code").alias("town_code"))
    towns = lookup(town_rows, counties, ["county_name"], small=small)

    def county_level(df: DataFrame) -> DataFrame:
        return df.select(
            "county_code",
            "county_name",
            empty.alias("town_code"),
            empty.alias("town_name"),
            F.lit("county").alias("geo_level"),
        )

    code, name = UNKNOWN_COUNTY
    unknown = members.sparkSession.range(1).select(
        F.lit(code).alias("county_code"), F.lit(name).alias("county_name")
    )
    places = (
        county_level(counties)
        .unionByName(county_level(unknown))
        .unionByName(towns.withColumn("geo_level", F.lit("town")))
    )
    return number_rows(places, ["county_name", "town_name"], "geo_key", small=small)
