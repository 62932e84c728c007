"""Sales time-series analytics and forecasting over panels of series, on Spark DataFrames."""

from panelcast.functions.calendar import resolve_freq
from panelcast.operators.decompose import decompose
from panelcast.operators.features import (
    add_calendar,
    add_lags,
    add_rolling,
    drop_incomplete,
    feature_table,
)
from panelcast.operators.metrics import align, choose_covering, keep_test_months, leaderboard, score
from panelcast.operators.periods import fill_period_gaps, horizon_calendar, to_periods
from panelcast.operators.scale import apply_scaler, fit_scaler, invert_scaler, scale_series
from panelcast.operators.sketches import count_between, distinct_sketches
from panelcast.operators.split import sequence_split, sequence_windows, time_split
from panelcast.operators.summaries import category_share, kpi_row, ranked_totals, year_month_pivot
from panelcast.plans.forecasting import (
    backtest,
    comparison_series,
    fit_parameters,
    forecast,
    forecast_parameters,
    load_sequence,
    save_sequence,
    train_sequence,
)
from panelcast.plans.reports import Dashboard, ModelComparison, exploration
from panelcast.plans.store import ForecastStore
from panelcast.session import build_session, materialize
from panelcast.sources.profile import load_summary, table_profile
from panelcast.sources.readers import labelled_sales, load_sales, observed_sales, rejected_rows
from panelcast.sources.sinks import write_table, write_tables

__all__ = [
    "Dashboard",
    "ForecastStore",
    "ModelComparison",
    "add_calendar",
    "add_lags",
    "add_rolling",
    "align",
    "apply_scaler",
    "backtest",
    "build_session",
    "category_share",
    "choose_covering",
    "comparison_series",
    "count_between",
    "decompose",
    "distinct_sketches",
    "drop_incomplete",
    "exploration",
    "feature_table",
    "fill_period_gaps",
    "fit_parameters",
    "fit_scaler",
    "forecast",
    "forecast_parameters",
    "horizon_calendar",
    "invert_scaler",
    "keep_test_months",
    "kpi_row",
    "labelled_sales",
    "leaderboard",
    "load_sales",
    "load_sequence",
    "load_summary",
    "materialize",
    "observed_sales",
    "ranked_totals",
    "rejected_rows",
    "resolve_freq",
    "save_sequence",
    "scale_series",
    "score",
    "sequence_split",
    "sequence_windows",
    "table_profile",
    "time_split",
    "to_periods",
    "train_sequence",
    "write_table",
    "write_tables",
    "year_month_pivot",
]
