"""Raw text tables to typed, canonical columns. Projections only: no shuffle, no write.

A raw table has string columns with '' for empty. Counts that do not parse become NULL
and are caught by the NOT NULL checks; dates that do not parse fail the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.functions import clean
from panelwatch.plans.schema import IMPORTED_CASE, IMPORTED_MONTHLY

# Column names of the sources.
YEAR, WEEK = "年", "週"
VISIT_TYPE, VISIT_AGE = "就診類別", "年齡別"
COUNTY, COUNTY_CODE, TOWN, TOWN_CODE = "縣市", "縣市別代碼", "鄉鎮", "鄉鎮別代碼"
FLU_VISITS, EV_VISITS, ALL_VISITS = "類流感健保就診人次", "腸病毒健保就診人次", "健保就診總人次"
ONSET_YEAR, ONSET_MONTH = "發病年份", "發病月份"
GENDER, AGE = "性別", "年齡層"
MONTHLY_IMPORTED, CASE_IMPORTED = "是否為境外移入", "是否境外移入"
CASES = "確定病例數"
ONSET_DAY, DETERMINED_DAY, REPORTED_DAY = "發病日", "個案研判日", "通報日"
HOME_COUNTY, HOME_TOWN = "居住縣市", "居住鄉鎮"
INFECTION_COUNTY, INFECTION_TOWN, INFECTION_COUNTRY = "感染縣市", "感染鄉鎮", "感染國家"
SEROTYPE, CENTROID_X, CENTROID_Y = "血清型", "最小統計區中心點X", "最小統計區中心點Y"


def _visits(raw: DataFrame, disease: str, count_column: str) -> DataFrame:
    return raw.select(
        F.lit(disease).alias("disease_code"),
        F.col(YEAR).alias("iso_year"),
        F.col(WEEK).alias("iso_week"),
        F.col(VISIT_TYPE).alias("visit_type"),
        clean.age_canon(F.col(VISIT_AGE)).alias("age_label"),
        F.col(COUNTY).alias("county_name"),
        clean.lenient_int(F.col(count_column)).alias("visit_count"),
        clean.lenient_int(F.col(ALL_VISITS)).alias("total_visit_count"),
    )


def stage_nhi(raw_flu: DataFrame, raw_ev: DataFrame) -> DataFrame:
    """Weekly visits of both diseases; each branch carries its code as a literal, so a
    filter on the code drops the other one from the plan."""
    return _visits(raw_flu, "FLU", FLU_VISITS).unionByName(_visits(raw_ev, "EV", EV_VISITS))


def stage_covid(raw_covid: DataFrame) -> DataFrame:
    """Monthly counts by place, gender and age."""
    return raw_covid.select(
        clean.lenient_int(F.col(ONSET_YEAR)).alias("onset_year"),
        clean.lenient_int(F.col(ONSET_MONTH)).alias("onset_month"),
        F.col(COUNTY).alias("county_name"),
        F.col(TOWN).alias("town_name"),
        clean.norm_gender(F.col(GENDER)).alias("gender_code"),
        clean.age_canon(F.col(AGE)).alias("age_label"),
        clean.flag(F.col(MONTHLY_IMPORTED), IMPORTED_MONTHLY).alias("is_imported"),
        clean.lenient_int(F.col(CASES)).alias("case_count"),
    )


def stage_dengue(raw_dengue: DataFrame) -> DataFrame:
    """One row per case."""
    return raw_dengue.select(
        clean.strict_slash_date(F.col(ONSET_DAY)).alias("onset_date"),
        clean.optional_slash_date(F.col(DETERMINED_DAY)).alias("determined_date"),
        clean.optional_slash_date(F.col(REPORTED_DAY)).alias("reported_date"),
        clean.norm_gender(F.col(GENDER)).alias("gender_code"),
        clean.age_canon(F.col(AGE)).alias("age_label"),
        F.col(HOME_COUNTY).alias("res_county"),
        F.col(HOME_TOWN).alias("res_town"),
        F.col(INFECTION_COUNTY).alias("inf_county"),
        F.col(INFECTION_TOWN).alias("inf_town"),
        clean.flag(F.col(CASE_IMPORTED), IMPORTED_CASE).alias("is_imported"),
        clean.blank_to_null(F.col(INFECTION_COUNTRY)).alias("infection_country"),
        clean.blank_to_null(F.col(SEROTYPE)).alias("serotype"),
        clean.lenient_double(F.col(CENTROID_X)).alias("centroid_x"),
        clean.lenient_double(F.col(CENTROID_Y)).alias("centroid_y"),
        clean.lenient_int(F.col(CASES)).alias("case_count"),
    )
