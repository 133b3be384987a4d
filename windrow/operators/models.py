"""Linear regression, per group and global, with tidy results."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.functions.student import two_sided_p
from windrow.operators.groups import apply_partitions
from windrow.session import scratch_dir
from windrow.sources.readers import local_frame

# A residual below this share of the total is rounding: the line is exact.
EXACT_FIT = 1e-12

# Pairs of columns that one native aggregation holds, to stay within compiled code. More go through
# matrix products of whole batches, merged in so many tasks before the last one.
PAIRS_AT_ONCE, MERGE_TASKS = 200, 32

# Columns that the values of text columns may be spread to, all together.
MAX_LEVELS = 1000

# A column whose variance the columns before it explain but for this share is redundant.
REDUNDANT = 1e-9


@F.pandas_udf(T.DoubleType())
def p_value(statistic: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(two_sided_p(statistic.to_numpy(float), df.to_numpy(float)))


def group_moments(df: DataFrame, group: str, y: str, x: str) -> DataFrame:
    """Counts, means and centred sums per group, in one native aggregation."""
    rows = F.count(F.lit(1))
    return (
        df.select(group, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
        .dropna()
        .groupBy(group)
        .agg(
            rows.alias("n"),
            F.avg("_x").alias("mx"),
            F.avg("_y").alias("my"),
            (F.var_pop("_x") * rows).alias("sxx"),
            (F.var_pop("_y") * rows).alias("syy"),
            (F.covar_pop("_x", "_y") * rows).alias("sxy"),
        )
    )


def _ratio(top: Column, bottom: Column) -> Column:
    """Division that is null over zero, as a statistic without spread has no value."""
    return F.try_divide(top, bottom)


def tidy_lines(moments: DataFrame, group: str, x: str) -> DataFrame:
    """Two rows per group, intercept and slope, from its moments.

    Without spread in x the intercept is the mean and the slope null; two points leave
    no degree of freedom, so errors are null; an exact line has error 0 and p 0.
    """
    flat = F.col("sxx") == 0
    slope = _ratio(F.col("sxy"), F.col("sxx"))
    df = F.col("n") - F.when(flat, 1).otherwise(2)
    rest = F.when(flat, F.col("syy")).otherwise(F.col("syy") - F.col("sxy") * slope)
    rest = F.when(rest <= F.col("syy") * EXACT_FIT, 0.0).otherwise(rest)
    lines = (
        moments.withColumn("slope", slope)
        .withColumn("df", df)
        .withColumn("var", F.when(df > 0, rest / df))
        .withColumn("level", F.when(flat, F.col("my")).otherwise(F.col("my") - F.col("slope") * F.col("mx")))
        .withColumn(
            "level_error",
            F.sqrt(F.col("var") * (1 / F.col("n") + F.coalesce(_ratio(F.col("mx") * F.col("mx"), F.col("sxx")), F.lit(0.0)))),
        )
        .withColumn("slope_error", F.sqrt(_ratio(F.col("var"), F.col("sxx"))))
    )
    long = lines.select(
        F.col(group),
        F.col("df"),
        F.inline(
            F.array(
                F.struct(F.lit("(Intercept)").alias("term"), F.col("level").alias("estimate"), F.col("level_error").alias("std_error")),
                F.struct(F.lit(x).alias("term"), F.col("slope").alias("estimate"), F.col("slope_error").alias("std_error")),
            )
        ),
    )
    infinite = F.when(F.col("estimate") > 0, F.lit(float("inf"))).when(F.col("estimate") < 0, F.lit(float("-inf")))
    statistic = F.when(F.col("std_error") == 0, infinite).otherwise(F.try_divide("estimate", "std_error"))
    return (
        long.withColumn("statistic", statistic)
        .withColumn("p_value", F.nanvl(p_value("statistic", F.col("df").cast("double")), F.lit(None).cast("double")))
        .select(group, "term", "estimate", "std_error", "statistic", "p_value")
    )


def group_ols(df: DataFrame, group: str, y: str, x: str) -> DataFrame:
    """Regression of y on x in every group: (group, term, estimate, std_error, statistic, p_value).

    Rows with a null in any of the three columns are left out. One shuffle of partial
    sums; Python sees only the finished statistics.
    """
    return tidy_lines(group_moments(df, group, y, x), group, x)


def _partial_moments(group: str, y: str, x: str):
    """Per batch and group: rows, means and centred sums. No square of a raw value is taken."""

    def summarise(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.dropna()
        values = pd.DataFrame({group: rows[group], "x": rows[x].astype(float), "y": rows[y].astype(float)})
        means = values.groupby(group, as_index=False).agg(n=("x", "size"), mx=("x", "mean"), my=("y", "mean"))
        apart = values.merge(means, on=group)
        dx, dy = apart["x"] - apart["mx"], apart["y"] - apart["my"]
        sums = pd.DataFrame({group: apart[group], "sxx": dx * dx, "syy": dy * dy, "sxy": dx * dy})
        return means.merge(sums.groupby(group, as_index=False).sum(), on=group)

    return summarise


def merged_moments(parts: DataFrame, group: str) -> DataFrame:
    """One set of moments per group from any number of them, by two native aggregations.

    First the mean of the group, then the sums about it: sums of squares of parts are
    moved to that mean, so no square of a raw value is taken here either.
    """
    rows = F.sum("n")
    means = parts.groupBy(F.col(group).alias("_group")).agg(
        rows.alias("_n"), (F.sum(F.col("n") * F.col("mx")) / rows).alias("_mx"), (F.sum(F.col("n") * F.col("my")) / rows).alias("_my")
    )
    both = parts.join(means, F.col(group) == F.col("_group"))
    dx, dy = F.col("mx") - F.col("_mx"), F.col("my") - F.col("_my")
    return both.groupBy(group).agg(
        F.first("_n").alias("n"),
        F.first("_mx").alias("mx"),
        F.first("_my").alias("my"),
        F.sum(F.col("sxx") + F.col("n") * dx * dx).alias("sxx"),
        F.sum(F.col("syy") + F.col("n") * dy * dy).alias("syy"),
        F.sum(F.col("sxy") + F.col("n") * dx * dy).alias("sxy"),
    )


def _finish_lines(group: str, x: str):
    def finish(sums: pd.DataFrame) -> pd.DataFrame:
        n, mx, my, sxx, syy, sxy = (sums[c].to_numpy(float) for c in ("n", "mx", "my", "sxx", "syy", "sxy"))
        flat = sxx == 0
        with np.errstate(divide="ignore", invalid="ignore"):
            slope = np.where(flat, np.nan, sxy / sxx)
            df = n - np.where(flat, 1, 2)
            rest = np.where(flat, syy, syy - sxy * slope)
            rest = np.where(rest <= EXACT_FIT * syy, 0.0, rest)
            var = np.where(df > 0, rest / df, np.nan)
            level = np.where(flat, my, my - slope * mx)
            level_error = np.sqrt(var * (1 / n + np.where(flat, 0.0, mx * mx / sxx)))
            slope_error = np.where(flat, np.nan, np.sqrt(var / sxx))
            estimate = np.concatenate([level, slope])
            error = np.concatenate([level_error, slope_error])
            statistic = np.where((error == 0) & (estimate == 0), np.nan, estimate / error)
        return pd.DataFrame(
            {
                group: pd.concat([sums[group], sums[group]], ignore_index=True),
                "term": ["(Intercept)"] * len(n) + [x] * len(n),
                "estimate": estimate,
                "std_error": error,
                "statistic": statistic,
                "p_value": two_sided_p(statistic, np.concatenate([df, df])),
            }
        )

    return finish


def group_ols_by_function(df: DataFrame, group: str, y: str, x: str) -> DataFrame:
    """The same regression through Python functions: moments per batch, merged by Spark.

    A cross-check of ``group_ols``. No rows of a group meet in one task, nor do its moments: there is one
    set of them for each batch that holds some, kept in working files for the two passes of the merge.
    """
    rows = df.select(group, y, x).dropna()
    kind = rows.schema[group].dataType.simpleString()
    schema = f"{group} {kind}, n bigint, mx double, my double, sxx double, syy double, sxy double"
    staged = scratch_dir(df.sparkSession, "moments")
    apply_partitions(rows, _partial_moments(group, y, x), schema).write.parquet(staged)
    merged = merged_moments(df.sparkSession.read.schema(schema).parquet(staged), group)
    result = f"{group} {kind}, term string, estimate double, std_error double, statistic double, p_value double"
    return apply_partitions(merged, _finish_lines(group, x), result)


Moments = tuple[int, np.ndarray, np.ndarray]


def _joined(a: Moments | None, b: Moments) -> Moments:
    """Moments of two sets of rows together, by their distance from one another."""
    if a is None or not a[0]:
        return b
    n = a[0] + b[0]
    apart = b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


def wide_moments(rows: DataFrame, size: int) -> Moments:
    """``cross_moments`` in one job for any number of columns, by a matrix product per batch.

    Every task hands on one matrix; these are merged in a fixed number of tasks, then in one.
    """
    schema = "n long, means binary, products binary"

    def batch(moments: Moments) -> pa.RecordBatch:
        n, *parts = moments
        columns = [pa.array([n], pa.int64()), *[pa.array([part.tobytes()], pa.binary()) for part in parts]]
        return pa.RecordBatch.from_arrays(columns, ["n", "means", "products"])

    def moments_of(n: int, means: bytes, products: bytes) -> Moments:
        return n, np.frombuffer(means), np.frombuffer(products).reshape(size, size)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for part in batches:
            if part.num_rows:
                values = np.column_stack([column.to_numpy(zero_copy_only=False) for column in part.columns])
                means = values.mean(axis=0)
                values -= means
                held = _joined(held, (part.num_rows, means, values.T @ values))
        if held:
            yield batch(held)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for part in batches:
            for row in zip(*[column.to_pylist() for column in part.columns]):
                held = _joined(held, moments_of(*row))
        if held:
            yield batch(held)

    parts = rows.select(*[f"v{i}" for i in range(size)]).mapInArrow(summed, schema)
    last = parts.repartition(MERGE_TASKS).mapInArrow(merged, schema).repartition(1).mapInArrow(merged, schema).first()
    if last is None:
        return 0, np.zeros(size), np.zeros((size, size))
    return moments_of(last["n"], bytes(last["means"]), bytes(last["products"]))


def cross_moments(rows: DataFrame, size: int) -> Moments:
    """Rows, means and centred cross products of the columns v0, v1, ..., in one job."""
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    if len(pairs) > PAIRS_AT_ONCE:
        return wide_moments(rows, size)
    cross, means = np.zeros((size, size)), np.zeros(size)
    sums = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(f"v{i}").alias(f"m{i}") for i in range(size)],
        *[F.covar_pop(f"v{i}", f"v{j}").alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    if sums["n"]:
        means[:] = [sums[f"m{i}"] for i in range(size)]
        for i, j in pairs:
            cross[i, j] = cross[j, i] = sums[f"c{i}_{j}"] * sums["n"]
    return sums["n"], means, cross


def complete_rows(df: DataFrame) -> DataFrame:
    """Rows without nulls, by a test per column.

    ``dropna`` makes one test over all columns; with many renamed columns the optimiser then derives a
    constraint for every way to mix old and new names.
    """
    return df.where(" AND ".join(f"`{name}` IS NOT NULL" for name in df.columns)) if df.columns else df


Levels = Mapping[str, Sequence[str]]


def text_columns(schema: T.StructType, names: Sequence[str]) -> list[str]:
    """Those of the columns whose values are names and no quantities."""
    kinds = {f.name: f.dataType for f in schema.fields}
    return [c for c in names if isinstance(kinds[c], (T.StringType, T.BooleanType))]


def levels_of(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """The distinct values of text columns, in order, from one pass; nulls are none.

    Refuses columns that have more than ``MAX_LEVELS`` together: they are no groups.
    """
    if not columns:
        return {}
    pairs = F.array(*[F.struct(F.lit(i).alias("column"), F.col(f"`{c}`").cast("string").alias("level")) for i, c in enumerate(columns)])
    found = df.select(F.explode(pairs).alias("_p")).select("_p.*").dropna().distinct().limit(MAX_LEVELS + 1).collect()
    if len(found) > MAX_LEVELS:
        raise ValueError(f"{list(columns)} have more than {MAX_LEVELS} different values")
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for row in found:
        levels[columns[row["column"]]].append(row["level"])
    return {c: sorted(some) for c, some in levels.items()}


def design_columns(features: Sequence[str], levels: Levels) -> dict[str, Column]:
    """The numbers that stand for features, by term.

    A text column becomes one column of 0 and 1 for each of its levels but the first, the base, under
    the name of the column with the level. A value that is no level has nulls there: its row is
    left out of a fit and gets no prediction.
    """
    terms: dict[str, Column] = {}
    for name in features:
        column = F.col(f"`{name}`")
        if name not in levels:
            terms[name] = column.cast("double")
            continue
        text = column.cast("string")
        known = text.isin(list(levels[name])) if levels[name] else F.lit(False)
        for level in levels[name][1:]:
            terms[f"{name}{level}"] = F.when(known, (text == level).cast("double"))
    return terms


def swept(spread: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Columns that those before them don't make up, and the inverse of their cross products.

    Columns are swept one by one, in order, scaled to unit variance: what is left on the diagonal
    is the share of a column's variance that the columns before it don't explain. Row operations
    only: no library that starts threads of its own.
    """
    scale = np.sqrt(np.diag(spread))
    usable = scale > 0
    unit = np.where(usable, scale, 1.0)
    table = spread / np.outer(unit, unit)
    chosen: list[int] = []
    for i in np.flatnonzero(usable).tolist():
        pivot = table[i, i]
        if pivot <= REDUNDANT:
            continue
        row, column = table[i] / pivot, table[:, i].copy()
        table -= np.outer(column, row)
        table[i], table[:, i] = row, -column / pivot
        table[i, i] = 1 / pivot
        chosen.append(i)
    inverse = table[np.ix_(chosen, chosen)]
    return chosen, (inverse + inverse.T) / 2 / np.outer(scale[chosen], scale[chosen])


def ols(df: DataFrame, y: str, features: Sequence[str] | None = None) -> DataFrame:
    """Regression of y on the given columns, or on all others, as a tidy coefficient table.

    Aggregations give means and covariances, from which the driver solves the normal equations
    for the columns scaled to unit variance. A column that is constant or made up by those before
    it has an empty estimate, and takes no degree of freedom. Text columns count by their levels
    against the first one in order (see ``design_columns``). Rows with a null in any column are
    left out, also from the levels. ``fit_line`` gives a model to save.
    """
    features = list(features) if features is not None else [c for c in df.columns if c != y]
    complete = complete_rows(df.select(*[F.col(f"`{c}`") for c in [*features, y]]))
    terms = design_columns(features, levels_of(complete, text_columns(df.schema, features)))
    features, names = list(terms), [*terms, y]
    numbers = [*terms.values(), F.col(f"`{y}`").cast("double")]
    rows = complete_rows(complete.select(*[c.alias(f"v{i}") for i, c in enumerate(numbers)]))
    n, means, cross = cross_moments(rows, len(names))
    spread, with_y, total = cross[:-1, :-1], cross[:-1, -1], cross[-1, -1]
    chosen, inverse = swept(spread)
    free = n - 1 - len(chosen)
    if free < 0 or n == 0:
        raise ValueError(f"{n} complete rows are too few for {len(chosen) + 1} coefficients")
    slopes = inverse @ with_y[chosen]
    rest = total - slopes @ with_y[chosen]
    variance = (0.0 if rest <= EXACT_FIT * total else rest) / free if free else np.nan
    center = means[:-1][chosen]
    estimates, spreads = np.full(len(names), np.nan), np.full(len(names), np.nan)
    places = [0, *(i + 1 for i in chosen)]
    estimates[places] = [means[-1] - slopes @ center, *slopes]
    spreads[places] = [1 / n + center @ inverse @ center, *np.diag(inverse)]
    return _coefficients(df.sparkSession, features, estimates, np.sqrt(variance * spreads), free)


def _coefficients(
    spark: SparkSession, features: Sequence[str], estimates: np.ndarray, errors: np.ndarray, free: float
) -> DataFrame:
    terms = ["(Intercept)", *features]
    with np.errstate(divide="ignore", invalid="ignore"):
        statistics = estimates / errors
    p = two_sided_p(statistics, np.full(len(terms), float(free)))
    known = [[None if np.isnan(v) else float(v) for v in row] for row in zip(estimates, errors, statistics, p)]
    rows = [(t, *values) for t, values in zip(terms, known)]
    return local_frame(spark, rows, "term string, estimate double, std_error double, statistic double, p_value double")


def fit_line(df: DataFrame, y: str, features: Sequence[str] | None = None, levels: Levels | None = None) -> LinearRegressionModel:
    """Least squares of y on the given columns, or on all others.

    Text columns need their ``levels``, from ``levels_of``, which ``predict`` is given as well.
    """
    features = list(features) if features is not None else [c for c in df.columns if c != y]
    terms = [c.alias(f"_term{i}") for i, c in enumerate(design_columns(features, levels or {}).values())]
    rows = complete_rows(df.select(F.col(f"`{y}`"), *terms))
    vectors = VectorAssembler(inputCols=rows.columns[1:], outputCol="features").transform(rows)
    return LinearRegression(labelCol=y, featuresCol="features", solver="normal", regParam=0.0).fit(vectors)


def predict(model: LinearRegressionModel, df: DataFrame, features: Sequence[str], levels: Levels | None = None) -> DataFrame:
    """The rows with their ``prediction``; null where a feature is null or no known level."""
    terms = {f"_term{i}": c for i, c in enumerate(design_columns(features, levels or {}).values())}
    vectors = VectorAssembler(inputCols=list(terms), outputCol="features", handleInvalid="keep").transform(df.withColumns(terms))
    made = model.transform(vectors).drop("features", *terms)
    return made.withColumn("prediction", F.nanvl("prediction", F.lit(None).cast("double")))


def tidy_model(spark: SparkSession, model: LinearRegressionModel, features: Sequence[str]) -> DataFrame:
    """Coefficient table of a fitted model, intercept first."""
    summary = model.summary
    errors = np.array(summary.coefficientStandardErrors)
    errors = np.concatenate([errors[-1:], errors[:-1]])  # the summary has the intercept last
    estimates = np.array([model.intercept, *model.coefficients])
    return _coefficients(spark, features, estimates, errors, summary.degreesOfFreedom)


def save_model(model: LinearRegressionModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> LinearRegressionModel:
    return LinearRegressionModel.load(path)
