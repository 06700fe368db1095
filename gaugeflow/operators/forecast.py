"""Per-series trend and additive models, fitted from sums.

A fit never gathers a series in one place. The linear model is two built-in
aggregates. The additive model is ridge least squares, whose normal equations
are sums over the rows: each task adds up its own rows batch by batch, Spark
adds the parts, and one small system per series is left to solve.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions import design
from gaugeflow.functions.times import micros_of
from gaugeflow.operators.series import (
    HORIZON,
    STEP_SECONDS,
    future_frame,
    gate,
    in_steps,
    is_crowded,
    series_index,
    with_config,
)
from gaugeflow.operators.skew import per_key_join
from gaugeflow.session import cut_lineage

DAILY_ORDER = 6
# What a report says about the size of a series.
SIZE_COLUMNS = ("n", "reliability")


# ---------------------------------------------------------------- linear trend


def _linear_terms(step, where=None):
    """The model as aggregates: slope per step and the means of time and target.

    Centred, which stays exact at large epoch times. `where` restricts the rows
    that are fitted.
    """
    t, y = in_steps("ds", step), F.col("y")
    if where is not None:
        t, y = F.when(where, t), F.when(where, y)
    return {"slope": F.regr_slope(y, t), "t_mean": F.avg(t), "y_mean": F.avg(y)}


def fit_linear(df: DataFrame, key="series_key", step=STEP_SECONDS, where=None) -> DataFrame:
    """One row per series: `n`, `slope` (0 if it has one row), `t_mean`, `y_mean`."""
    terms = [term.alias(name) for name, term in _linear_terms(step, where).items()]
    model = df.groupBy(key).agg(F.count("*").alias("n"), *terms)
    return model.fillna(0.0, ["slope"])


def linear_value(time="ds", step=STEP_SECONDS):
    """Prediction of the linear model in the row at `time`."""
    return F.col("y_mean") + F.col("slope") * (in_steps(time, step) - F.col("t_mean"))


def _train_rows():
    return F.col("idx") < F.col("train_size")


def with_linear_model(
    df: DataFrame, key="series_key", step=STEP_SECONDS, ties=(), crowded=None
) -> DataFrame:
    """Every row with its position, its settings and the model of its series' training rows.

    Ordinary series get all of it in the one shuffle and sort that numbers
    their rows; for a crowded series the model is aggregated and joined.
    """
    crowded = is_crowded(df, key) if crowded is None else crowded
    split = with_config(series_index(df, key, "ds", ties, crowded))
    if crowded:
        model = fit_linear(split, key, step, _train_rows()).drop("n")
        return per_key_join(split, model, [key])
    series = Window.partitionBy(key)
    terms = {name: term.over(series) for name, term in _linear_terms(step, _train_rows()).items()}
    return split.withColumns(terms).fillna(0.0, ["slope"])


def forecast_linear(
    df: DataFrame, key="series_key", step=STEP_SECONDS, periods=HORIZON, origin="last",
    ties=(), history=True, crowded=None,
) -> DataFrame:
    """Historic rows and `periods` future ones with `yhat` and `is_future`.

    The leading training rows are fitted; the future starts after the last row
    (`origin="last"`) or after the training rows (`origin="train_end"`), where
    the history ends then as well.
    """
    rows = with_linear_model(df, key, step, ties, crowded)
    end = F.col({"last": "n", "train_end": "train_size"}[origin])
    rows = rows.where(F.col("idx") < end) if history else rows.where(F.col("idx") == end - 1)
    # The last row of the history is the one the future grows from.
    first = F.lit(-1) if history else F.lit(0)
    last = F.when(F.col("idx") == end - 1, F.lit(periods - 1)).otherwise(F.lit(-1))
    steps = rows.withColumn("_step", F.explode(F.sequence(first, last)))
    ahead = (F.col("_step") + 1).cast("long") * F.lit(micros_of(step))
    moved = steps.withColumn("ds", F.timestamp_micros(F.unix_micros("ds") + ahead))
    return moved.select(
        key,
        "ds",
        F.when(F.col("_step") >= 0, F.col("_step")).alias("step_no"),
        linear_value(step=step).alias("yhat"),
        (F.col("_step") >= 0).alias("is_future"),
        *SIZE_COLUMNS,
    )


def holdout_metrics(
    df: DataFrame, key="series_key", step=STEP_SECONDS, ties=(), crowded=None
) -> DataFrame:
    """Mean absolute and root mean squared error of the linear model on the rows not fitted."""
    rows = with_linear_model(df, key, step, ties, crowded)
    miss = F.col("y") - linear_value(step=step)
    return (
        rows.where(~_train_rows())
        .groupBy(key)
        .agg(
            F.count("*").alias("held_out"),
            F.avg(F.abs(miss)).alias("mae"),
            F.sqrt(F.avg(miss * miss)).alias("rmse"),
        )
    )


def backtest_linear(
    df: DataFrame, key="series_key", step=STEP_SECONDS, horizon=HORIZON, every=HORIZON, least=10, ties=()
) -> DataFrame:
    """Errors of the linear model at many origins: per series and `trained`, the number of rows fitted.

    The first `least` rows of a series are fitted, then `every` more each time; each model is
    tested on the up to `horizon` rows that follow. The sums behind a model run along with
    the rows, so an origin costs one solution and no further scan; a row meets the models
    of the rows before it in the same sorted window. Origins without a row behind them
    have no result.
    """
    indexed = series_index(df, key, "ds", ties)
    order = Window.partitionBy(key).orderBy("idx")
    terms = {name: term.over(order) for name, term in _linear_terms(step).items()}
    fitted = indexed.withColumns(terms).fillna(0.0, ["slope"])
    rows = F.col("idx") + 1
    origin = (rows >= least) & ((rows - least) % every == 0)
    model = F.when(origin, F.struct(rows.alias("trained"), "slope", "t_mean", "y_mean"))
    before = F.collect_list("_model").over(order.rowsBetween(-horizon, -1))
    tested = fitted.withColumn("_model", model).withColumn("_models", before)
    each = tested.select(key, "ds", "y", F.explode("_models").alias("_m")).select(key, "ds", "y", "_m.*")
    miss = F.col("y") - linear_value(step=step)
    return each.groupBy(key, "trained").agg(
        F.count("*").alias("held_out"), F.avg(F.abs(miss)).alias("mae"), F.sqrt(F.avg(miss * miss)).alias("rmse")
    )


def _future(model, key, step, periods, origin):
    start = {"last": "last_ds", "train_end": "train_end"}[origin]
    return future_frame(model, start, step, periods).withColumn("is_future", F.lit(True))


# -------------------------------------------------------------- additive model


# What a prediction needs to know about its series, besides the coefficients.
MODEL_COLUMNS = {
    "n": "BIGINT",
    "changepoints": "INT",
    "daily": "BOOLEAN",
    "t0": "BIGINT",
    "t_span": "DOUBLE",
    "use_regressor": "BOOLEAN",
    "x_mean": "DOUBLE",
    "x_std": "DOUBLE",
    "x_last": "DOUBLE",
    "train_end": "TIMESTAMP",
    "last_ds": "TIMESTAMP",
}


def fit_additive(
    df: DataFrame, key="series_key", ties=(), daily_order=DAILY_ORDER, trend_reg=1.0,
    crowded=None,
) -> DataFrame:
    """One row per series: `MODEL_COLUMNS` and the `coefficients`.

    Fits `(key, ds, y, x)` rows: piecewise-linear trend, daily waves for series
    of 50 rows or more, and the regressor where it varies. Ordinary series take
    one shuffle; the rows of a crowded one are spread over tasks and their sums
    added up. The result is written to the shared folder, since forecasts read
    it more than once.
    """
    crowded = is_crowded(df, key) if crowded is None else crowded
    train = _spread_train_rows if crowded else _train_rows_in_order
    fitted = train(df, key, ties).where(F.col("y").isNotNull())
    terms = design.features("ds", F.col("x"), daily_order)
    size, settings = len(terms), list(MODEL_COLUMNS)
    shaped = fitted.select(
        key, *settings, *[term.alias(f"_f{i}") for i, term in enumerate(terms)], "y"
    )
    # Rows of a series side by side: one result per task and series.
    schema = ", ".join(f"{name} {kind}" for name, kind in MODEL_COLUMNS.items())
    sums = shaped.sortWithinPartitions(key).mapInArrow(
        _sums_per_series(len(settings), size), f"{key} STRING, {schema}, sums ARRAY<DOUBLE>"
    )
    if crowded:
        totals = ", ".join(f"sum(sums[{i}])" for i in range(size * (size + 1) // 2 + size))
        sums = sums.groupBy(key, *settings).agg(F.expr(f"array({totals})").alias("sums"))
    solve = _solver(design.penalties(daily_order, trend_reg))
    return cut_lineage(sums.select(key, *settings, solve("sums").alias("coefficients")))


def _settings(split, aggregate):
    """Model columns of numbered rows; `aggregate` says over what an aggregate runs.

    Only fixed-width values, so that an aggregation needs no sort.
    """
    last, cut = F.col("n") - 1, F.col("train_size") - 1
    terms = {
        "t0": F.min(F.unix_micros("ds")),
        "train_end": F.max(F.when(F.col("idx") == cut, F.col("ds"))),
        "x_std": F.stddev_samp("x"),
        "x_mean": F.avg(F.when(_train_rows(), F.col("x"))),
        "x_last": F.max(F.when(F.col("idx") == last, F.col("x"))),
        "last_ds": F.max("ds"),
    }
    span = F.unix_micros("train_end") - F.col("t0")
    return aggregate(split, terms).withColumns(
        {
            "t_span": F.greatest(span, F.lit(1)).cast("double"),
            "use_regressor": gate(F.col("x_std")),
        }
    )


def _train_rows_in_order(df, key, ties):
    """Training rows with their model columns; the window keeps a series in one task."""
    whole = Window.partitionBy(key)
    split = with_config(series_index(df, key, "ds", ties, crowded=False))

    def over_series(rows, terms):
        return rows.withColumns({name: term.over(whole) for name, term in terms.items()})

    return _settings(split, over_series).where(_train_rows())


def _spread_train_rows(df, key, ties):
    """Training rows with their model columns, crowded series spread over several tasks."""
    split = with_config(series_index(df, key, "ds", ties, crowded=True))

    def per_series(rows, terms):
        aggregates = [term.alias(name) for name, term in terms.items()]
        return with_config(rows.groupBy(key).agg(F.max("n").alias("n"), *aggregates))

    settings = cut_lineage(_settings(split, per_series))
    rows = split.where(_train_rows()).select(key, "ds", "y", "x")
    return per_key_join(rows, settings, [key])


def _sums_per_series(settings, size):
    """Feature products and feature-target products of each run of equal keys.

    Columns of a batch: key, `settings` columns to keep, `size` features, target.
    """
    upper = np.triu_indices(size)

    def result(labels, grams):
        sums = [np.concatenate([gram[upper], gram[:, size]]) for gram in grams]
        columns = [*labels.columns, pa.array(sums, pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays(columns, [*labels.schema.names, "sums"])

    def run(batches):
        pending = None
        for batch in batches:
            if not batch.num_rows:
                continue
            # A NULL key is a series like any other.
            codes = batch.column(0).dictionary_encode().indices.fill_null(-1).to_numpy()
            starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
            columns = batch.columns[settings + 1 :]
            matrix = np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns])
            grams = []
            for start, end in zip(starts, [*starts[1:], len(codes)]):
                block = matrix[start:end]
                grams.append(block[:, :size].T @ block)
            names = batch.schema.names[: settings + 1]
            labels = batch.select(names).take(pa.array(starts))
            if pending and pending[0].column(0)[0] == labels.column(0)[0]:
                grams[0] += pending[1]
            elif pending:
                yield result(pending[0], [pending[1]])
            # The last series may go on in the next batch.
            if len(grams) > 1:
                yield result(labels.slice(0, len(grams) - 1), grams[:-1])
            pending = (labels.slice(len(grams) - 1), grams[-1])
        if pending:
            yield result(pending[0], [pending[1]])

    return run


def _solver(weights):
    size = len(weights)
    upper = np.triu_indices(size)

    @F.pandas_udf("array<double>")
    def solve(sums: pd.Series) -> pd.Series:
        if sums.empty:
            return pd.Series([], dtype=object)
        flat = np.stack(sums.to_numpy())
        gram = np.zeros((len(flat), size, size))
        gram[:, upper[0], upper[1]] = flat[:, : len(upper[0])]
        gram[:, upper[1], upper[0]] = flat[:, : len(upper[0])]
        gram += np.diag(weights)
        answers = np.linalg.solve(gram, flat[:, len(upper[0]) :, None])[:, :, 0]
        return pd.Series(list(answers))

    return solve


def additive_value(regressor, daily_order=DAILY_ORDER, time="ds"):
    """Prediction of `fit_additive`'s model; the model columns must be in the row."""
    terms = design.features(time, regressor, daily_order)
    total = F.lit(0.0)
    for position, term in enumerate(terms):
        total = total + term * F.col("coefficients")[position]
    return total


def forecast_additive(
    df: DataFrame, key="series_key", step=STEP_SECONDS, periods=HORIZON, origin="last", ties=(),
    daily_order=DAILY_ORDER, trend_reg=1.0, history=True, crowded=None,
) -> DataFrame:
    """Like `forecast_linear`, with the additive model.

    Future rows use the last observed regressor value of the whole series;
    historic rows keep their own.
    """
    crowded = is_crowded(df, key) if crowded is None else crowded
    model = fit_additive(df, key, ties, daily_order, trend_reg, crowded)
    ahead = with_config(_future(model, key, step, periods, origin))
    ahead = ahead.withColumn("yhat", additive_value(F.col("x_last"), daily_order))
    columns = [key, "ds", "step_no", "yhat", "is_future", *SIZE_COLUMNS]
    if not history:
        return ahead.select(columns)
    past = per_key_join(df.select(key, "ds", "x"), model, [key])
    if origin == "train_end":
        past = past.where(F.col("ds") <= F.col("train_end"))
    past = with_config(past).select(
        key,
        "ds",
        F.lit(None).cast("int").alias("step_no"),
        additive_value(F.col("x"), daily_order).alias("yhat"),
        F.lit(False).alias("is_future"),
        *SIZE_COLUMNS,
    )
    return past.unionByName(ahead.select(columns))
