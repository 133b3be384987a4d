"""Regression queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.functions.dates import in_month
from windrow.operators import models
from windrow.operators.shaping import complete_cases
from windrow.plans.inputs import load
from windrow.plans.registry import query
from windrow.session import scratch_dir

# Digits kept when results are compared with another engine.
DIGITS = {"estimate": 3, "std_error": 3, "statistic": 6, "p_value": 8}


def december(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = load(spark, sf_dir, "lineitem").filter(in_month(F.col("l_shipdate"), 12))
    return complete_cases(
        items.select(
            F.col("l_suppkey").alias("origin"), F.col("l_quantity").alias("dep_delay"), F.col("l_extendedprice").alias("arr_delay")
        )
    )


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, DIGITS[c]).alias(c) if c in DIGITS else F.col(c) for c in df.columns])


@query(
    "features_december",
    "SELECT l_suppkey AS origin, l_quantity AS dep_delay, l_extendedprice AS arr_delay FROM lineitem "
    "WHERE month(l_shipdate) = 12 AND l_suppkey IS NOT NULL AND l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL",
)
def features_december(spark: SparkSession, sf_dir: str) -> DataFrame:
    return december(spark, sf_dir)


# Student's t for whole degrees of freedom as a finite series, summed from its last term.
P_SQL = """CASE WHEN df % 2 = 1 THEN
        1 - 2 / pi() * (atan(abs(statistic) / sqrt(df)) + CASE WHEN df = 1 THEN 0 ELSE
            sqrt(1 - q) * sqrt(q) * list_reduce(range(CAST((df - 3) / 2 AS BIGINT), 0, -1),
                lambda acc, k: 1 + acc * q * (2 * k) / (2 * k + 1), 1.0::DOUBLE) END)
    ELSE 1 - sqrt(1 - q) * list_reduce(range(CAST((df - 2) / 2 AS BIGINT), 0, -1),
                lambda acc, k: 1 + acc * q * (2 * k - 1) / (2 * k), 1.0::DOUBLE) END"""

GROUP_OLS_SQL = f"""
WITH sums AS (
    SELECT l_suppkey AS origin, COUNT(*) AS n, regr_slope(l_extendedprice, l_quantity) AS slope,
        regr_intercept(l_extendedprice, l_quantity) AS level, regr_sxx(l_extendedprice, l_quantity) AS sxx,
        regr_syy(l_extendedprice, l_quantity) AS syy, regr_sxy(l_extendedprice, l_quantity) AS sxy,
        avg(l_quantity) AS mx
    FROM lineitem WHERE month(l_shipdate) = 12 GROUP BY 1
), fits AS (
    SELECT *, n - 2 AS df, sqrt(greatest(syy - sxy * sxy / sxx, 0) / (n - 2)) AS s FROM sums
), terms AS (
    SELECT origin, '(Intercept)' AS term, level AS estimate, s * sqrt(1.0 / n + mx * mx / sxx) AS std_error, df FROM fits
    UNION ALL SELECT origin, 'dep_delay', slope, s / sqrt(sxx), df FROM fits
), tests AS (
    SELECT *, estimate / std_error AS statistic, df / (df + pow(estimate / std_error, 2)) AS q FROM terms
)
SELECT origin, term, round(estimate, 3) AS estimate, round(std_error, 3) AS std_error,
    round(statistic, 6) AS statistic, round({P_SQL}, 8) AS p_value FROM tests
"""


@query("group_ols_tidy", GROUP_OLS_SQL)
def group_ols_tidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A regression per origin, two tidy rows each, from one native aggregation."""
    return rounded(models.group_ols(december(spark, sf_dir), "origin", "arr_delay", "dep_delay"))


@query("group_ols_udf", GROUP_OLS_SQL)
def group_ols_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same regression through Python functions."""
    return rounded(models.group_ols_by_function(december(spark, sf_dir), "origin", "arr_delay", "dep_delay"))


GLOBAL_OLS_SQL = """
WITH m AS (
    SELECT COUNT(*) AS n, avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_extendedprice) AS my,
        regr_sxx(l_extendedprice, l_quantity) AS s11, regr_sxx(l_extendedprice, l_discount) AS s22,
        regr_sxy(l_discount, l_quantity) AS s12, regr_sxy(l_extendedprice, l_quantity) AS s1y,
        regr_sxy(l_extendedprice, l_discount) AS s2y, regr_syy(l_extendedprice, l_quantity) AS syy
    FROM lineitem
), b AS (
    SELECT *, s11 * s22 - s12 * s12 AS det, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
        (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM m
), f AS (
    SELECT *, my - b1 * m1 - b2 * m2 AS b0, (syy - b1 * s1y - b2 * s2y) / (n - 3) AS v FROM b
), t AS (
    SELECT '(Intercept)' AS term, b0 AS estimate,
        sqrt(v * (1.0 / n + (m1 * m1 * s22 + m2 * m2 * s11 - 2 * m1 * m2 * s12) / det)) AS std_error FROM f
    UNION ALL SELECT 'l_quantity', b1, sqrt(v * s22 / det) FROM f
    UNION ALL SELECT 'l_discount', b2, sqrt(v * s11 / det) FROM f
)
SELECT term, round(estimate, 3) AS estimate, round(std_error, 3) AS std_error, round(estimate / std_error, 4) AS statistic FROM t
"""


@query("global_ols", GLOBAL_OLS_SQL)
def global_ols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One regression on all other columns."""
    items = load(spark, sf_dir, "lineitem").select("l_extendedprice", "l_quantity", "l_discount")
    table = models.ols(items, "l_extendedprice")
    return table.select(
        "term", F.round("estimate", 3).alias("estimate"), F.round("std_error", 3).alias("std_error"),
        F.round("statistic", 4).alias("statistic"),
    )


@query(
    "global_ols_redundant",
    GLOBAL_OLS_SQL + " UNION ALL SELECT 'half_quantity', NULL, NULL, NULL",
)
def global_ols_redundant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that another one makes up: its term is empty, the others are as without it."""
    items = load(spark, sf_dir, "lineitem").select("l_extendedprice", "l_quantity", "l_discount")
    table = models.ols(items.withColumn("half_quantity", F.col("l_quantity") / 2), "l_extendedprice")
    return table.select(
        "term", F.round("estimate", 3).alias("estimate"), F.round("std_error", 3).alias("std_error"),
        F.round("statistic", 4).alias("statistic"),
    )


@query(
    "global_ols_text",
    """
WITH g AS (
    SELECT l_returnflag AS flag, COUNT(*) AS n, avg(l_quantity) AS mx, avg(l_extendedprice) AS my,
        regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_syy(l_extendedprice, l_quantity) AS syy,
        regr_sxy(l_extendedprice, l_quantity) AS sxy FROM lineitem GROUP BY 1
), f AS (
    SELECT sum(sxx) AS sxx, sum(sxy) / sum(sxx) AS b,
        (sum(syy) - sum(sxy) * sum(sxy) / sum(sxx)) / (sum(n) - count(*) - 1) AS v FROM g
), base AS (SELECT * FROM g WHERE flag = (SELECT min(flag) FROM g)),
t AS (
    SELECT '(Intercept)' AS term, my - b * mx AS estimate, sqrt(v * (1.0 / n + mx * mx / f.sxx)) AS std_error FROM base, f
    UNION ALL SELECT 'l_quantity', b, sqrt(v / sxx) FROM f
    UNION ALL SELECT 'l_returnflag' || g.flag, (g.my - b * g.mx) - (base.my - b * base.mx),
        sqrt(v * (1.0 / g.n + 1.0 / base.n + (g.mx - base.mx) * (g.mx - base.mx) / f.sxx))
    FROM g, f, base WHERE g.flag <> base.flag
)
SELECT term, round(estimate, 3) AS estimate, round(std_error, 3) AS std_error, round(estimate / std_error, 4) AS statistic FROM t
""",
)
def global_ols_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One regression on all other columns, one of them text: its levels against the first."""
    items = load(spark, sf_dir, "lineitem").select("l_extendedprice", "l_quantity", "l_returnflag")
    table = models.ols(items, "l_extendedprice")
    return table.select(
        "term", F.round("estimate", 3).alias("estimate"), F.round("std_error", 3).alias("std_error"),
        F.round("statistic", 4).alias("statistic"),
    )


@query(
    "model_roundtrip",
    "SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_different, true AS predicts FROM lineitem",
)
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model saved and loaded predicts as before."""
    features = ["l_quantity", "l_discount"]
    items = load(spark, sf_dir, "lineitem").select("l_extendedprice", *features)
    model, path = models.fit_line(items, "l_extendedprice"), scratch_dir(spark, "model")
    models.save_model(model, path)
    loaded = models.load_model(path)
    before = models.predict(model, items, features).withColumnRenamed("prediction", "before")
    both = models.predict(loaded, before, features)
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("before") != F.col("prediction")).alias("n_different"),
        (F.max("prediction") > F.min("prediction")).alias("predicts"),
    )
