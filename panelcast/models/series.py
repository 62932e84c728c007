"""One row per series: the table every forecaster works on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.calendar import periods_between, resolve_freq, shift_label
from panelcast.operators.split import MIN_POINTS, train_size
from panelcast.session import materialize


#: Points of a panel that one task packs and fits; a parameter search takes well under a second for them.
POINTS_PER_TASK = 20_000


def work_partitions(points: int) -> int:
    """How many tasks a panel of so many points is worth."""
    return max(1, -(-points // POINTS_PER_TASK))


def series_arrays(
    panel: DataFrame,
    keys: Sequence[str] = (),
    target: str = "sales",
    order: str = "period",
    partitions: int | None = None,
) -> DataFrame:
    """``keys…, periods, ys, n, last_period``: the history as two arrays in time order.

    Takes a panel, never raw facts: its rows per series are bounded by the number of calendar
    periods, so a row stays small however many facts the series was summed from. Rows are few bytes but
    much work, which size-based coalescing would pack into too few tasks. So a keyed panel is stored, its
    points are counted from the files, and the shuffle gets a partition for every ``POINTS_PER_TASK``
    (or ``partitions``, without storing). A null or NaN value fails the query: left out, it would shift
    every later lag and season.
    """
    if keys:
        if partitions is None:
            panel = materialize(panel.select(*keys, order, target), "panel")
            partitions = work_partitions(panel.count())
        panel = panel.repartition(partitions, *keys)
    value = F.col(target).cast("double")
    missing = F.raise_error(F.concat(F.lit("no value at "), F.col(order).cast("string"))).cast("double")
    value = F.when(value.isNull() | F.isnan(value), missing).otherwise(value)
    points = F.sort_array(F.collect_list(F.struct(F.col(order).alias("p"), value.alias("v"))))
    packed = panel.groupBy(*keys).agg(points.alias("points"))
    return packed.where(F.size("points") > 0).select(
        *keys,
        F.col("points.p").alias("periods"),
        F.col("points.v").alias("ys"),
        F.size("points").alias("n"),
        F.element_at("points", -1)["p"].alias("last_period"),
    )


def hold_out(
    series: DataFrame,
    freq: str,
    test_ratio: float = 0.2,
    fit_scope: str = "train",
    min_points: int = MIN_POINTS,
) -> DataFrame:
    """Cut each series in time: fit on the first part, keep the rest as test arrays.

    Adds ``test_periods, test_ys, full_ys, status`` and ``steps``, the number of calendar periods from
    the last fitted to the last test period. ``fit_scope='all'`` fits on the whole series and
    scores in-sample on the same test periods. Series under ``min_points`` are marked.
    """
    if fit_scope not in ("train", "all"):
        raise ValueError("fit_scope is 'train' or 'all'")
    cut = train_size(F.col("n"), test_ratio)
    out = series.withColumns(
        {
            "status": F.when(F.col("n") < min_points, "too_short").otherwise("ok"),
            "n_train": F.greatest(F.lit(1), cut),
            "full_ys": F.col("ys"),
        }
    ).withColumns(
        {
            "test_periods": F.slice("periods", F.col("n_train") + 1, F.col("n")),
            "test_ys": F.slice("ys", F.col("n_train") + 1, F.col("n")),
        }
    )
    if fit_scope == "train":
        out = out.withColumns(
            {
                "periods": F.slice("periods", F.lit(1), F.col("n_train")),
                "ys": F.slice("ys", F.lit(1), F.col("n_train")),
            }
        ).withColumns({"n": F.col("n_train"), "last_period": F.element_at("periods", -1)})
    steps = F.greatest(
        F.lit(1), periods_between(F.col("last_period"), F.try_element_at("test_periods", F.lit(-1)), freq)
    )
    return out.withColumn("steps", F.coalesce(steps, F.lit(1))).drop("n_train")


def with_horizon(series: DataFrame, horizon: int) -> DataFrame:
    return series.withColumn("steps", F.lit(int(horizon)))


def explode_rows(df: DataFrame, columns: Sequence, array: Column | str, name: str) -> DataFrame:
    """``columns…, pos, name``: one row per array element; null and empty arrays give none.

    The outer form is used on purpose: a plain explode makes the optimizer push an
    "array is not empty" filter below the projections, which repeats every model expression
    the array is computed from.
    """
    rows = df.select(*columns, F.posexplode_outer(array).alias("pos", name))
    return rows.where(F.col("pos").isNotNull())


def explode_forecast(df: DataFrame, keys: Sequence[str], freq: str, columns: Sequence[str]) -> DataFrame:
    """``yhat`` arrays to rows ``keys…, columns…, step, ds, yhat``; labels follow the series."""
    f = resolve_freq(freq)
    rows = explode_rows(df, [*keys, *columns, "last_period"], "yhat", "yhat")
    return rows.select(
        *keys,
        *columns,
        (F.col("pos") + 1).alias("step"),
        shift_label(F.col("last_period"), f, F.col("pos") + 1).alias("ds"),
        "yhat",
    )


def explode_test(df: DataFrame, keys: Sequence[str], freq: str, model: Column) -> DataFrame:
    """Test points with the forecast of the same date: ``keys…, model, ds, y, yhat``.

    The forecast array holds one value per calendar step after ``last_period``, so the date
    difference is its index and gaps in the test periods cannot shift the pairing.
    """
    test = F.arrays_zip("test_periods", "test_ys")
    rows = explode_rows(df, [*keys, model.alias("model"), "last_period", "yhat"], test, "_test")
    ds = F.col("_test.test_periods")
    index = periods_between(F.col("last_period"), ds, freq) - 1
    return rows.select(*keys, "model", ds.alias("ds"), F.col("_test.test_ys").alias("y"),
                       F.get("yhat", index).alias("yhat"))


def array_total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
