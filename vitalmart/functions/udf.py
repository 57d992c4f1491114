"""Category functions for SQL users: session SQL functions, inlined by the optimizer.

They are expressions, not Python UDFs, so they run in generated code.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from vitalmart.functions.bands import Ladder
from vitalmart.rules import clinical as R


def _case(x: str, ladder: Ladder) -> str:
    quote = lambda s: "'" + s.replace("'", "\\'") + "'"
    arms = [f"WHEN {x} IS NULL THEN {quote(ladder.null)}"] if ladder.null else []
    sign = "<" if ladder.closed == "left" else "<="
    arms += [f"WHEN {x} {sign} {e} THEN {quote(v)}" for e, v in zip(ladder.edges, ladder.labels)]
    return f"CASE {' '.join(arms)} ELSE {quote(ladder.labels[-1])} END"


def register_sql_functions(spark: SparkSession) -> None:
    """categorize_bmi/age/glucose and calculate_risk_category as temporary functions."""
    for name, ladder in (("categorize_bmi", R.BMI_SIMPLE), ("categorize_age", R.AGE_RANGES),
                         ("categorize_glucose", R.GLUCOSE_FOUR)):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x DOUBLE) RETURNS STRING RETURN {_case('x', ladder)}")
    score = ("CASE WHEN glucose >= 126 THEN 3 WHEN glucose >= 100 THEN 2 ELSE 0 END + CASE WHEN bmi >= 30 THEN 2 WHEN bmi >= 25"
             " THEN 1 ELSE 0 END + CASE WHEN age >= 65 THEN 2 WHEN age >= 50 THEN 1 ELSE 0 END + int(coalesce(pregnancies > 5,"
             " false)) + int(coalesce(pedigree > 0.5d, false))")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION calculate_risk_category(glucose DOUBLE, bmi DOUBLE, age INT, pregnancies INT,"
              f" pedigree DOUBLE) RETURNS STRING RETURN CASE WHEN {score} >= 6 THEN 'High' WHEN {score} >= 3 THEN 'Medium'"
              " ELSE 'Low' END")
