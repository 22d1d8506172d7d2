"""Tables, constraints and fixed members of the star schema."""

from __future__ import annotations

TABLES = {
    "dim_date": (
        "date_key int, full_date date, year smallint, quarter tinyint, month tinyint, day tinyint, "
        "iso_year smallint, iso_week tinyint, day_of_week tinyint, "
        "is_month_start boolean, is_iso_week_start boolean"
    ),
    "dim_geography": (
        "geo_key bigint, county_code string, county_name string, town_code string, "
        "town_name string, geo_level string"
    ),
    "dim_disease": (
        "disease_key int, disease_code string, disease_name string, disease_category string"
    ),
    "dim_age_group": "age_key int, age_label string, age_lower smallint, age_upper smallint",
    "dim_gender": "gender_key int, gender_code string, gender_label string",
    "fact_nhi_visits": (
        "visit_id bigint, date_key int, geo_key bigint, disease_key int, age_key int, "
        "visit_type string, period_type string, iso_year smallint, iso_week tinyint, "
        "visit_count int, total_visit_count int"
    ),
    "fact_covid_cases": (
        "covid_id bigint, date_key int, geo_key bigint, disease_key int, age_key int, "
        "gender_key int, period_type string, onset_year smallint, onset_month tinyint, "
        "is_imported boolean, case_count int"
    ),
    # onset_year is the storage partition; the other columns are the fact's own.
    "fact_dengue_cases": (
        "dengue_case_id bigint, onset_date_key int, determined_date_key int, "
        "reported_date_key int, residence_geo_key bigint, infection_geo_key bigint, "
        "disease_key int, age_key int, gender_key int, is_imported boolean, "
        "infection_country string, serotype string, centroid_x double, centroid_y double, "
        "case_count int, onset_year smallint"
    ),
    "agg_weekly": (
        "disease_name string, county_name string, iso_year int, iso_week int, "
        "week_start_date date, metric_value bigint, denominator bigint, disease_code string"
    ),
    "agg_monthly": (
        "county_name string, onset_year int, onset_month int, month_start date, cases bigint"
    ),
}

DIMENSIONS = ("dim_date", "dim_geography", "dim_disease", "dim_age_group", "dim_gender")
FACTS = ("fact_nhi_visits", "fact_covid_cases", "fact_dengue_cases")
PARTITIONED_BY = {
    "fact_nhi_visits": "iso_year",
    "fact_covid_cases": "onset_year",
    "fact_dengue_cases": "onset_year",
    "agg_weekly": "disease_code",
}

UNIQUE = {
    "dim_date": (("date_key",),),
    "dim_geography": (("geo_key",), ("county_name", "town_name")),
    "dim_disease": (("disease_key",), ("disease_code",)),
    "dim_age_group": (("age_key",), ("age_label",)),
    "dim_gender": (("gender_key",), ("gender_code",)),
    "fact_nhi_visits": (("visit_id",),),
    "fact_covid_cases": (("covid_id",),),
    "fact_dengue_cases": (("dengue_case_id",),),
}

NULLABLE = {
    "dim_disease": {"disease_category"},
    "dim_age_group": {"age_lower", "age_upper"},
    "fact_dengue_cases": {
        "determined_date_key",
        "reported_date_key",
        "infection_geo_key",
        "infection_country",
        "serotype",
        "centroid_x",
        "centroid_y",
    },
}

REFERENCES = {
    "fact_nhi_visits": {
        "date_key": ("dim_date", "date_key"),
        "geo_key": ("dim_geography", "geo_key"),
        "disease_key": ("dim_disease", "disease_key"),
        "age_key": ("dim_age_group", "age_key"),
    },
    "fact_covid_cases": {
        "date_key": ("dim_date", "date_key"),
        "geo_key": ("dim_geography", "geo_key"),
        "disease_key": ("dim_disease", "disease_key"),
        "age_key": ("dim_age_group", "age_key"),
        "gender_key": ("dim_gender", "gender_key"),
    },
    "fact_dengue_cases": {
        "onset_date_key": ("dim_date", "date_key"),
        "determined_date_key": ("dim_date", "date_key"),
        "reported_date_key": ("dim_date", "date_key"),
        "residence_geo_key": ("dim_geography", "geo_key"),
        "infection_geo_key": ("dim_geography", "geo_key"),
        "disease_key": ("dim_disease", "disease_key"),
        "age_key": ("dim_age_group", "age_key"),
        "gender_key": ("dim_gender", "gender_key"),
    },
}


def columns(table: str) -> list[str]:
    return [part.split()[0] for part in TABLES[table].split(", ")]


# Fixed values.
DISEASES = (
    (1, "FLU", "流感", "第四類法定傳染病"),
    (2, "EV", "腸病毒感染併發重症", "第三類法定傳染病"),
    (3, "19CoV", "嚴重特殊傳染性肺炎", "第五類法定傳染病"),
    (4, "DENGUE", "登革熱", "第二類法定傳染病"),
)
GENDERS = ((1, "M", "男"), (2, "F", "女"), (3, "U", "不詳"))
UNKNOWN_COUNTY = ("00000", "未知")
CALENDAR = ("1998-01-01", "2026-12-31")
IMPORTED_MONTHLY = "1"
IMPORTED_CASE = "是"
