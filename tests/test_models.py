import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from windrow.functions.student import two_sided_p
from windrow.operators import groups, models
from windrow.plans.models import december
from windrow.sources.readers import local_frame


def by_term(df, group):
    return {(r[group], r["term"]): r for r in df.collect()}


def test_p_values():
    """Fixed values from tables of Student's t."""
    t = [2.228138852, 12.7062047364, 40.0, 0.0, math.inf, -2.228138852]
    p = two_sided_p(np.array(t), np.array([10.0, 1, 43, 5, 7, 10]))
    assert p[0] == pytest.approx(0.05, rel=1e-8) and p[1] == pytest.approx(0.05, rel=1e-9)
    assert p[2] == pytest.approx(1.179e-35, rel=1e-3)
    assert p[3] == 1.0 and p[4] == 0.0 and p[5] == p[0]
    assert np.isnan(two_sided_p(np.array([np.nan, 1.0]), np.array([3.0, 0.0]))).all()


def test_p_values_against_the_closed_forms():
    t = np.linspace(-30, 30, 301)
    assert two_sided_p(t, np.full(301, 1.0)) == pytest.approx(1 - 2 / np.pi * np.arctan(np.abs(t)), abs=1e-13)
    assert two_sided_p(t, np.full(301, 2.0)) == pytest.approx(1 - np.abs(t) / np.sqrt(2 + t * t), abs=1e-13)
    normal = np.array([math.erfc(abs(x) / math.sqrt(2)) for x in t[::20]])
    assert two_sided_p(t[::20], np.full(len(normal), 1e9)) == pytest.approx(normal, rel=1e-5)


@pytest.mark.parametrize("t", [2.0, 10.0, 20.0, 35.0])
def test_p_values_for_many_degrees_of_freedom(t):
    """Against an integral of the density, taken from its value at t outward."""
    df = 100_001.0
    steps = np.linspace(0, 60 / t, 400_001)
    shape = np.exp(-(df + 1) / 2 * (np.log1p((t + steps) ** 2 / df) - np.log1p(t * t / df)))
    width = steps[1]
    area = width / 3 * (shape[0] + shape[-1] + 4 * shape[1:-1:2].sum() + 2 * shape[2:-1:2].sum())
    log_height = math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - 0.5 * math.log(df * math.pi)
    log_height -= (df + 1) / 2 * math.log1p(t * t / df)
    assert two_sided_p(np.array([t]), np.array([df]))[0] == pytest.approx(2 * math.exp(log_height) * area, rel=1e-9)


def test_golden_group(spark, medium):
    got = by_term(models.group_ols(december(spark, medium), "origin", "arr_delay", "dep_delay"), "origin")
    assert len(got) == 200
    level, slope = got[7, "(Intercept)"], got[7, "dep_delay"]
    assert tuple(level)[2:] == pytest.approx((53240.983371, 9166.239108, 5.808378196, 6.9422836e-07), rel=1e-7)
    assert tuple(slope)[2:] == pytest.approx((-135.635023, 307.641190, -0.440887070, 0.6615035431), rel=1e-7)


DEGENERATE = [
    ("a", 1.0, 5.0),
    ("b", 1.0, 2.0), ("b", 3.0, 8.0),
    ("c", 2.0, 1.0), ("c", 2.0, 3.0), ("c", 2.0, 8.0),
    ("d", 1.0, 3.0), ("d", 2.0, 5.0), ("d", 4.0, 9.0),
    ("e", 1.0, None), ("e", 2.0, None),
    ("f", 1.0, 4.0), ("f", 2.0, 4.0), ("f", 3.0, 4.0),
    (None, 1.0, 1.0), (None, 2.0, 5.0),
]


@pytest.mark.parametrize("fit", [models.group_ols, models.group_ols_by_function])
def test_degenerate_groups(spark, fit):
    df = local_frame(spark, DEGENERATE, "g string, x double, y double")
    got = by_term(fit(df, "g", "y", "x"), "g")
    value = lambda g, t: tuple(got[g, t])[2:]
    assert {g for g, _ in got} == {"a", "b", "c", "d", "f"} and len(got) == 10
    nothing = (None, None, None)
    assert value("a", "(Intercept)") == (5.0, *nothing)
    assert value("a", "x") == (None, *nothing)
    assert value("b", "(Intercept)") == (pytest.approx(-1.0), *nothing)
    assert value("b", "x") == (pytest.approx(3.0), *nothing)
    estimate, error, statistic, p = value("c", "(Intercept)")
    assert (estimate, error) == (pytest.approx(4.0), pytest.approx(math.sqrt(13 / 3)))
    assert statistic == pytest.approx(4 / math.sqrt(13 / 3))
    assert p == pytest.approx(1 - statistic / math.sqrt(2 + statistic**2))
    assert value("c", "x") == (None, *nothing)
    assert value("d", "x") == (pytest.approx(2.0), 0.0, math.inf, 0.0)
    assert value("d", "(Intercept)") == (pytest.approx(1.0), 0.0, math.inf, 0.0)
    assert value("f", "x") == (0.0, 0.0, None, None)
    assert value("f", "(Intercept)") == (pytest.approx(4.0), 0.0, math.inf, 0.0)


def test_three_routes_agree_also_with_a_hot_group(spark):
    """A third of the rows in one group, in different layouts."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("g"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10).alias("x"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 7).alias("y"),
    )

    def fit(key, rows):
        x, y = rows["x"].to_numpy(), rows["y"].to_numpy()
        design = np.column_stack([np.ones_like(x), x])
        beta, rss, *_ = np.linalg.lstsq(design, y, rcond=None)
        error = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * rss[0] / (len(x) - 2))
        return pd.DataFrame(
            {"g": key[0], "term": ["(Intercept)", "x"], "estimate": beta, "std_error": error,
             "statistic": beta / error, "p_value": two_sided_p(beta / error, np.full(2, len(x) - 2.0))}
        )

    schema = "g long, term string, estimate double, std_error double, statistic double, p_value double"
    routes = [
        models.group_ols(df, "g", "y", "x"),
        models.group_ols(df.repartition(7), "g", "y", "x"),
        models.group_ols_by_function(df, "g", "y", "x"),
        groups.apply_groups(df, ["g"], fit, schema),
    ]
    first, *others = [by_term(r, "g") for r in routes]
    for other in others:
        assert first.keys() == other.keys()
        for key in first:
            assert tuple(first[key])[2:] == pytest.approx(tuple(other[key])[2:], rel=1e-7, abs=1e-9)


@pytest.mark.parametrize("fit", [models.group_ols, models.group_ols_by_function])
def test_a_large_mean_leaves_the_line_as_it_is(spark, fit):
    points = [(x, 3 * x + 1 + (x % 3 - 1) * 0.5) for x in range(7)]
    plain = by_term(fit(local_frame(spark, [("a", float(x), float(y)) for x, y in points], "g string, x double, y double"), "g", "y", "x"), "g")
    shifted = local_frame(spark, [("a", x + 1e8, float(y)) for x, y in points], "g string, x double, y double")
    moved = by_term(fit(shifted.repartition(3), "g", "y", "x"), "g")
    assert tuple(moved["a", "x"])[2:] == pytest.approx(tuple(plain["a", "x"])[2:], rel=1e-7)


def test_redundant_columns_have_empty_terms(spark):
    df = spark.range(200).select(
        (F.col("id") % 17).cast("double").alias("x"), (F.pmod(F.xxhash64("id"), F.lit(100)) / 7).alias("u"),
    ).withColumns({"z": F.col("x") * 0.7, "one": F.lit(4.0), "far": F.col("u") + 1e8})
    df = df.withColumn("y", 5 + 2 * F.col("x") - F.col("u") + F.sin("u"))
    got = {r["term"]: r for r in models.ols(df.select("y", "x", "z", "one", "u"), "y").collect()}
    want = {r["term"]: r for r in models.ols(df.select("y", "x", "u"), "y").collect()}
    assert got["z"]["estimate"] is None and got["one"]["estimate"] is None and got["z"]["p_value"] is None
    for term in want:
        assert tuple(got[term])[1:] == pytest.approx(tuple(want[term])[1:], rel=1e-9)


def test_many_columns(spark):
    df = spark.range(300).select(*[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 9).alias(f"c{i}") for i in range(25)])
    df = df.withColumn("y", sum((F.col(f"c{i}") * i for i in range(25)), F.lit(2.0)))
    got = {r["term"]: r["estimate"] for r in models.ols(df, "y").collect()}
    assert [got[f"c{i}"] for i in range(25)] == pytest.approx(list(range(25)), abs=1e-8)


def test_global_fit_equals_the_group_fit(spark, medium):
    rows = december(spark, medium).filter("origin = 7")
    model = models.fit_line(rows.select("arr_delay", "dep_delay"), "arr_delay")
    table = models.tidy_model(spark, model, ["dep_delay"]).collect()
    group = models.group_ols(rows, "origin", "arr_delay", "dep_delay").collect()
    for a, b in zip(sorted(table, key=lambda r: r["term"]), sorted(group, key=lambda r: r["term"])):
        assert tuple(a)[1:] == pytest.approx(tuple(b)[2:], rel=1e-7)


def test_fit_on_all_other_columns_equals_the_library(spark, medium):
    rows = spark.read.parquet(f"{medium}/lineitem.parquet").select("l_extendedprice", "l_quantity", "l_discount", "l_tax")
    features = ["l_quantity", "l_discount", "l_tax"]
    library = models.tidy_model(spark, models.fit_line(rows, "l_extendedprice"), features).collect()
    for a, b in zip(models.ols(rows, "l_extendedprice").collect(), library):
        assert a["term"] == b["term"] and tuple(a)[1:] == pytest.approx(tuple(b)[1:], rel=1e-6)


def test_fit_of_an_exact_plane_and_of_too_few_rows(spark):
    df = spark.range(20).select((F.col("id") % 5).alias("a"), (F.col("id") * F.col("id") % 7).alias("b"))
    plane = df.withColumn("y", F.lit(3) + F.col("a") * 2 - F.col("b"))
    got = {r["term"]: r for r in models.ols(plane, "y").collect()}
    assert [got[t]["estimate"] for t in ("(Intercept)", "a", "b")] == pytest.approx([3, 2, -1])
    assert [got[t]["std_error"] for t in ("(Intercept)", "a", "b")] == [0.0, 0.0, 0.0]
    assert got["a"]["p_value"] == 0.0
    two = {r["term"]: r["estimate"] for r in models.ols(plane.orderBy("a", "b").limit(2), "y").collect()}
    assert sum(value is None for value in two.values()) == 1  # two points hold one slope
    with pytest.raises(ValueError):
        models.ols(plane.limit(0), "y")


def test_saved_model_predicts_the_same(spark, tmp_path):
    df = spark.range(50).select((F.col("id") * 2.0 + 1).alias("y"), F.col("id").cast("double").alias("x"))
    model = models.fit_line(df, "y")
    models.save_model(model, str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"))
    a, b = (models.predict(m, df, ["x"]).select("prediction").collect() for m in (model, again))
    assert a == b


def test_text_columns_count_by_level(spark):
    """Against a design matrix made by hand; rows with a null leave, also from the levels."""
    rng = np.random.default_rng(3)
    rows = [
        (str(rng.choice(["b", "a", "c", "é"])), bool(rng.random() < 0.5), float(x), int(x) % 7)
        for x in rng.integers(0, 50, 400)
    ]
    rows += [("only with a null", True, None, 1), (None, True, 4.0, 2)]
    schema = "color string, flag boolean, x double, w int"
    df = local_frame(spark, rows, schema).withColumn("y", F.col("x") * 2 + F.length("color") + F.pmod(F.xxhash64("x", "w", "color", "flag"), F.lit(13)))
    got = {r["term"]: r for r in models.ols(df, "y", ["color", "flag", "x", "w"]).collect()}
    known = df.dropna().toPandas()
    columns = {"(Intercept)": np.ones(len(known))}
    columns |= {f"color{c}": (known["color"] == c).to_numpy(float) for c in ("b", "c", "é")}
    columns |= {"flagtrue": known["flag"].to_numpy(float), "x": known["x"], "w": known["w"].to_numpy(float)}
    design = np.column_stack(list(columns.values()))
    beta, rss, *_ = np.linalg.lstsq(design, known["y"].to_numpy(float), rcond=None)
    error = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * rss[0] / (len(known) - len(columns)))
    assert list(got) == list(columns)
    for i, term in enumerate(columns):
        assert (got[term]["estimate"], got[term]["std_error"]) == (pytest.approx(beta[i], rel=1e-7), pytest.approx(error[i], rel=1e-7))


def test_text_with_one_level_or_too_many(spark, monkeypatch):
    df = spark.range(60).select(F.lit("same").alias("t"), F.col("id").cast("string").alias("many"), (F.col("id") * 2.0 + F.sin("id")).alias("y"), "id")
    got = models.ols(df, "y", ["t", "id"]).collect()
    assert [r["term"] for r in got] == ["(Intercept)", "id"]
    monkeypatch.setattr(models, "MAX_LEVELS", 59)
    with pytest.raises(ValueError, match="more than 59"):
        models.ols(df, "y", ["many", "id"])


def test_predictions_with_text_and_levels_never_seen(spark):
    df = spark.range(200).select(
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("t"), (F.col("id") % 11).cast("double").alias("x")
    ).withColumn("y", F.col("x") * 3 + F.when(F.col("t") == "b", 5.0).when(F.col("t") == "c", -2.0).otherwise(1.0))
    levels = models.levels_of(df, ["t"])
    assert levels == {"t": ["a", "b", "c"]}
    model = models.fit_line(df, "y", ["t", "x"], levels)
    new = local_frame(spark, [("a", 1.0), ("b", 2.0), ("z", 3.0), (None, 3.0), ("c", None)], "t string, x double")
    got = {(r["t"], r["x"]): r["prediction"] for r in models.predict(model, new, ["t", "x"], levels).collect()}
    assert got["a", 1.0] == pytest.approx(4.0) and got["b", 2.0] == pytest.approx(11.0)
    assert got["z", 3.0] is got[None, 3.0] is got["c", None] is None


def test_a_hundred_columns_in_one_job_equal_the_library(spark, monkeypatch):
    df = spark.range(0, 3000, 1, 7).select(
        *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 9 + (10 if i % 10 == 0 else 0)).alias(f"c{i}") for i in range(100)]
    )
    df = df.withColumn("y", F.col("c1") * 3 - F.col("c20") + F.col("c99") * 5 + F.pmod(F.xxhash64("c1", "c2"), F.lit(50)))
    df = df.cache()
    df.count()
    passes = []
    monkeypatch.setattr(models, "wide_moments", lambda *given, real=models.wide_moments: passes.append(1) or real(*given))
    mine = models.ols(df, "y").collect()
    assert len(passes) == 1
    library = models.tidy_model(spark, models.fit_line(df, "y"), [c for c in df.columns if c != "y"]).collect()
    for a, b in zip(mine, library):
        assert a["term"] == b["term"]
        if a["term"] != "(Intercept)":
            assert tuple(a)[1:4] == pytest.approx(tuple(b)[1:4], rel=1e-6)
    df.unpersist()


def test_both_ways_to_the_moments_agree(spark, monkeypatch):
    df = spark.range(0, 999, 1, 5).select(*[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(97)) + 1e7).cast("double").alias(f"v{i}") for i in range(4)])
    native = models.cross_moments(df, 4)
    monkeypatch.setattr(models, "PAIRS_AT_ONCE", 1)
    wide = models.cross_moments(df, 4)
    assert native[0] == wide[0] == 999
    assert np.allclose(native[1], wide[1], rtol=1e-13) and np.allclose(native[2], wide[2], rtol=1e-7)
    assert models.cross_moments(df.limit(0), 4)[0] == 0


def test_moments_of_a_hot_group_are_never_listed(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("x"), F.sin("id").alias("y"))
    plan = models.group_ols_by_function(df, "g", "y", "x")._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
