"""Forecast scores, ranking, alignment and coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions import money


def mean_absolute_error(y: Column, yhat: Column) -> Column:
    return F.avg(F.abs(y - yhat))


def root_mean_squared_error(y: Column, yhat: Column) -> Column:
    return F.sqrt(F.avg((y - yhat) * (y - yhat)))


def mean_absolute_percentage_error(y: Column, yhat: Column) -> Column:
    """Percent; zero actuals are ignored, null when nothing else is left."""
    return F.avg(F.when(y != 0, F.abs((y - yhat) / y))) * 100


def align(predictions: DataFrame, actuals: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Predictions (``ds, yhat``) paired with actuals (``period, sales``) by date."""
    actual = actuals.select(*keys, F.col("period").alias("ds"), F.col("sales").alias("y"))
    return predictions.join(actual, [*keys, "ds"])


def score(
    paired: DataFrame,
    keys: Sequence[str] = (),
    y: str = "y",
    yhat: str = "yhat",
    digits: int = 2,
) -> DataFrame:
    """``keys…, model, mae, rmse, mape`` with half-even rounding."""
    actual, predicted = F.col(y), F.col(yhat)
    return paired.groupBy(*keys, "model").agg(
        F.bround(mean_absolute_error(actual, predicted), digits).alias("mae"),
        F.bround(root_mean_squared_error(actual, predicted), digits).alias("rmse"),
        F.bround(mean_absolute_percentage_error(actual, predicted), digits).alias("mape"),
    )


def leaderboard(
    metrics: DataFrame, keys: Sequence[str] = (), model_order: Sequence[str] = ()
) -> DataFrame:
    """Add ``is_best`` (lowest MAPE; ties go to the model listed first; none where nothing was scored)
    and display text."""
    place = F.array_position(F.array(*[F.lit(m) for m in model_order]), F.col("model")) if model_order else F.lit(0)
    known = F.when(place > 0, place).otherwise(F.lit(len(model_order) + 1))
    spec = Window.partitionBy(*keys).orderBy(F.col("mape").asc_nulls_last(), known, "model")
    best = (F.row_number().over(spec) == 1) & F.col("mae").isNotNull()
    return metrics.withColumn("is_best", best).withColumns(
        {
            "mae_text": money.in_crore(F.col("mae")),
            "rmse_text": money.in_crore(F.col("rmse")),
        }
    )


def keep_test_months(forecast: DataFrame, test: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Forecast rows whose calendar month occurs in the test periods of the same series."""
    fc = forecast.withColumn("_month", F.trunc("ds", "MM"))
    months = test.select(*keys, F.trunc("period", "MM").alias("_month"))
    return fc.join(months, [*keys, "_month"], "left_semi").drop("_month")


def choose_covering(
    forecast: DataFrame, fallback: DataFrame, test: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """The forecast where it covers every test month of a series, else the fallback.

    Both inputs have columns ``keys…, model, ds, yhat``; ``covered`` tells which was used.
    """
    matched = keep_test_months(forecast, test, keys).withColumn("_own", F.lit(True))
    other = keep_test_months(fallback, test, keys).withColumn("_own", F.lit(False))
    marked = test.select(*keys).withColumn("_test", F.lit(1))
    needed = marked.groupBy(*keys).agg(F.count("_test").alias("_needed"))
    both = matched.unionByName(other)
    whole = Window.partitionBy(*keys)
    counted = both.withColumn("_have", F.count(F.when(F.col("_own"), 1)).over(whole))
    if keys:
        counted = counted.join(needed, list(keys))
    else:
        counted = counted.withColumn("_needed", needed.select("_needed").scalar())
    return (
        counted.withColumn("covered", F.col("_have") == F.col("_needed"))
        .where(F.col("_own") == F.col("covered"))
        .drop("_own", "_have", "_needed")
    )


def relative_band(df: DataFrame, value: str = "yhat", share: float = 0.08) -> DataFrame:
    """Add ``yhat_lower`` and ``yhat_upper`` at ``±share`` of the value."""
    return df.withColumns(
        {
            "yhat_lower": F.col(value) * F.lit(round(1 - share, 10)),
            "yhat_upper": F.col(value) * F.lit(round(1 + share, 10)),
        }
    )
