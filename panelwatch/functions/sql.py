"""The cleaning macros for use in SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from panelwatch.functions.clean import GENDER_CODES, UNKNOWN_GENDER


def register_functions(spark: SparkSession) -> None:
    """Define `age_canon` and `norm_gender` in the session. They are inlined into plans."""
    codes = ", ".join(f"'{code}'" for code in GENDER_CODES)
    bodies = {
        "age_canon": "replace(x, '~', '-')",
        "norm_gender": f"if(coalesce(x IN ({codes}), false), x, '{UNKNOWN_GENDER}')",
    }
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS STRING RETURN {body}")
