"""Untyped surveillance sources derived from the driver's tables.

Orders act as weekly and monthly reports of a customer's nation, line items as visits at
a supplier's nation and as a case list with a place of residence and one of infection.
All rows are used. Text is made as dirty as real sources are: unpadded dates, padded
numbers, two age separators, unknown codes, empty fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.functions import calendar
from panelwatch.operators.lookup import NARROW_BROADCAST_ROWS, fits_broadcast, lookup
from panelwatch.plans import staging as c

CALENDAR = ("1990-01-01", "2026-12-31")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def choose(key: Column, cases: dict, otherwise: str) -> Column:
    """A text per key value."""
    chosen = None
    for value, text in cases.items():
        condition = key == F.lit(value)
        chosen = F.when(condition, F.lit(text)) if chosen is None else chosen.when(condition, F.lit(text))
    return chosen.otherwise(F.lit(otherwise))


def whole(number: Column) -> Column:
    """The integer part of a non-negative number, as text."""
    return F.floor(number).cast("string")


def _day(ts: str) -> Column:
    return F.col(ts).cast("date")


def _unpadded(day: Column) -> Column:
    return F.date_format(day, "yyyy/M/d")


def _padded(day: Column) -> Column:
    return F.date_format(day, "yyyy/MM/dd")


def _nations(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return nation.select(
        F.col("n_nationkey").alias(f"{prefix}_nationkey"),
        F.col("n_name").alias(f"{prefix}_county"),
        (F.col("n_nationkey") + 10001).cast("string").alias(f"{prefix}_code"),
    )


def placed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the county of their customer; three sources are made of them."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment"
    )
    orders = lookup(table(spark, sf_dir, "orders"), customers, ["o_custkey"])
    return lookup(orders, _nations(spark, sf_dir, "c"), ["c_nationkey"])


def _with_supplier(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Line items, or what was joined to them, with the county of their supplier."""
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    small = fits_broadcast(suppliers, NARROW_BROADCAST_ROWS)
    supplied = lookup(lines, suppliers, ["l_suppkey"], small=small, keys_of=table(spark, sf_dir, "lineitem"))
    return lookup(supplied, _nations(spark, sf_dir, "s"), ["s_nationkey"])


def flu(orders: DataFrame) -> DataFrame:
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    return orders.select(
        calendar.iso_year(_day("o_orderdate")).cast("string").alias(c.YEAR),
        calendar.iso_week(_day("o_orderdate")).cast("string").alias(c.WEEK),
        choose(status, {"F": "住院", "O": "門診"}, "急診").alias(c.VISIT_TYPE),
        choose(
            F.col("c_mktsegment"),
            {"BUILDING": "0~2", "AUTOMOBILE": "3~4", "FURNITURE": "5~14", "HOUSEHOLD": "15~64"},
            "65+",
        ).alias(c.VISIT_AGE),
        F.col("c_county").alias(c.COUNTY),
        F.col("c_code").alias(c.COUNTY_CODE),
        F.when(status == "F", whole(price / 10000)).when(status == "O", F.lit(" 1 ")).otherwise("0")
        .alias(c.FLU_VISITS),
        whole(price / 1000).alias(c.ALL_VISITS),
    )


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    return _with_supplier(spark, sf_dir, table(spark, sf_dir, "lineitem")).select(
        calendar.iso_year(_day("l_shipdate")).cast("string").alias(c.YEAR),
        calendar.iso_week(_day("l_shipdate")).cast("string").alias(c.WEEK),
        choose(F.col("l_linestatus"), {"O": "門診"}, "急診").alias(c.VISIT_TYPE),
        choose(line, {1: "0~2", 2: "3~4", 3: "5~14", 4: "15~64"}, "65+").alias(c.VISIT_AGE),
        F.col("s_county").alias(c.COUNTY),
        F.col("s_code").alias(c.COUNTY_CODE),
        F.when(F.col("l_returnflag") == "R", line.cast("string")).otherwise("0").alias(c.EV_VISITS),
        whole(F.col("l_quantity") + line).alias(c.ALL_VISITS),
    )


def covid(orders: DataFrame) -> DataFrame:
    status, priority, segment = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("c_mktsegment")
    town = F.when(segment == "BUILDING", "").otherwise(segment)
    return orders.select(
        F.year(_day("o_orderdate")).cast("string").alias(c.ONSET_YEAR),
        F.month(_day("o_orderdate")).cast("string").alias(c.ONSET_MONTH),
        F.col("c_county").alias(c.COUNTY),
        town.alias(c.TOWN),
        F.when((town == "") | (status == "P"), "").otherwise(F.concat("c_code", F.substring(segment, 1, 1)))
        .alias(c.TOWN_CODE),
        F.when(status == "O", "M").when(status == "F", "F").when(priority == "1-URGENT", "").otherwise("X")
        .alias(c.GENDER),
        choose(
            priority,
            {"1-URGENT": "0", "2-HIGH": "1~4", "3-MEDIUM": "30-34", "4-NOT SPECIFIED": "不詳"},
            "70+",
        ).alias(c.AGE),
        F.when(F.col("o_totalprice") > 300000, "1").otherwise("0").alias(c.MONTHLY_IMPORTED),
        F.when(status == "F", whole(F.col("o_totalprice") / 2000)).otherwise("0").alias(c.CASES),
    )


def dengue(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    returned, status, line = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    segment = F.col("c_mktsegment")
    homes = orders.select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "c_mktsegment", "c_county"
    )
    lines = table(spark, sf_dir, "lineitem")
    at_home = lookup(lines, homes, ["l_orderkey"], salt_by=["l_partkey", "l_suppkey", "l_linenumber"])
    cases = _with_supplier(spark, sf_dir, at_home)
    unknown_home = (segment == "MACHINERY") & (status == "O") & (returned == "N")
    lon = F.concat(F.lit("120."), F.lpad(F.pmod("l_partkey", F.lit(100)).cast("string"), 2, "0"))
    lat = F.concat(F.lit("22."), F.lpad(F.pmod("l_suppkey", F.lit(100)).cast("string"), 2, "0"))
    return cases.select(
        F.when(status == "F", _unpadded(_day("l_shipdate"))).otherwise(_padded(_day("l_shipdate")))
        .alias(c.ONSET_DAY),
        F.when(returned == "N", "").otherwise(_padded(F.date_add(_day("l_shipdate"), 3)))
        .alias(c.DETERMINED_DAY),
        F.when(returned == "A", "").otherwise(_unpadded(_day("o_orderdate"))).alias(c.REPORTED_DAY),
        choose(returned, {"A": "M", "R": "F"}, "X").alias(c.GENDER),
        choose(line, {1: "0", 2: "1~4", 3: "5-14", 4: "30-34", 5: "65+", 6: "不詳"}, "70+").alias(c.AGE),
        F.when(unknown_home, "").otherwise(F.col("c_county")).alias(c.HOME_COUNTY),
        F.when(segment == "BUILDING", "").otherwise(segment).alias(c.HOME_TOWN),
        F.when(returned == "R", "").when(line == 7, "OFFSHORE").otherwise(F.col("s_county"))
        .alias(c.INFECTION_COUNTY),
        F.when(status == "O", "HARBOUR").otherwise("").alias(c.INFECTION_TOWN),
        F.when(returned == "R", "是").otherwise("否").alias(c.CASE_IMPORTED),
        F.when(returned == "R", F.col("s_county")).otherwise("").alias(c.INFECTION_COUNTRY),
        choose(line, {1: "第一型", 2: "第二型", 3: "第三型", 4: "第四型"}, "").alias(c.SEROTYPE),
        F.when(status == "O", "").otherwise(lon).alias(c.CENTROID_X),
        F.when((status == "O") | (line == 7), "").otherwise(lat).alias(c.CENTROID_Y),
        F.when((returned == "R") & (line <= 2), "1").otherwise("0").alias(c.CASES),
    )


def source(spark: SparkSession, sf_dir: str, role: str, orders: DataFrame | None) -> DataFrame:
    """One of the sources; all but `ev` are made of the placed orders."""
    if role == "ev":
        return ev(spark, sf_dir)
    return dengue(spark, sf_dir, orders) if role == "dengue" else {"flu": flu, "covid": covid}[role](orders)
