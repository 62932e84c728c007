"""The three end-to-end flows: exploration tables, model comparison, dashboard tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame

from panelcast.functions.calendar import resolve_freq
from panelcast.operators import metrics, summaries
from panelcast.operators.decompose import decompose
from panelcast.operators.features import feature_table
from panelcast.operators.periods import to_periods
from panelcast.operators.split import time_split
from panelcast.plans.forecasting import DEFAULT_HORIZON, MODELS, backtest, comparison_series, forecast
from panelcast.session import materialize


def exploration(
    facts: DataFrame,
    keys: Sequence[str] = (),
    freq: str = "MS",
    value: str = "Revenue",
    scale: int | None = 2,
    period: int | None = None,
) -> dict[str, DataFrame]:
    """Tables behind the exploration charts: trend, city totals, category shares, decomposition
    and the year-by-month table. City and category tables appear when the column exists. The season
    of the decomposition follows the frequency unless ``period`` is given."""
    period = resolve_freq(freq).season_length if period is None else period
    panel = to_periods(facts, keys, freq, sales_col=value, scale=scale)
    out = {
        "trend": panel,
        "decomposition": decompose(panel, keys, period),
        "year_month": summaries.year_month_pivot(facts, value, scale),
    }
    if "City" in facts.columns:
        out["city_totals"] = summaries.ranked_totals(facts, "City", value, scale)
    shares = summaries.category_share(facts, "Category", value, scale)
    if shares is not None:
        out["category_share"] = shares
    return out


class ModelComparison:
    """Features, split, back-test, ranking and forecasts of a fact table.

    Tables are built when first asked for. The panel and the predictions are written once to the
    shared folder, so the facts are read a single time however many models and tables follow.
    """

    def __init__(
        self,
        facts: DataFrame,
        keys: Sequence[str] = (),
        freq: str = "MS",
        where: Mapping[str, object] | None = None,
        models: Sequence[str] = MODELS,
        horizon: int = DEFAULT_HORIZON,
        test_ratio: float = 0.2,
        sales_col: str | None = None,
        scale: int | None = 2,
        **options,
    ):
        self.keys, self.freq, self.models = list(keys), freq, list(models)
        self.horizon, self.test_ratio, self.options = horizon, test_ratio, options
        self._aggregated = to_periods(facts, keys, freq, where, sales_col, scale=scale)

    @cached_property
    def panel(self) -> DataFrame:
        return materialize(self._aggregated, "panel")

    @cached_property
    def features(self) -> DataFrame:
        return feature_table(self.panel, self.keys)

    @cached_property
    def split(self) -> DataFrame:
        return time_split(self.panel, self.keys, self.test_ratio)

    @cached_property
    def predictions(self) -> DataFrame:
        rows = backtest(self.panel, self.keys, self.freq, self.models, self.test_ratio, **self.options)
        return materialize(rows, "predictions")

    @cached_property
    def leaderboard(self) -> DataFrame:
        return metrics.leaderboard(metrics.score(self.predictions, self.keys), self.keys, self.models)

    @cached_property
    def forecast(self) -> DataFrame:
        return forecast(self.panel, self.keys, self.freq, self.models, self.horizon, **self.options)

    @cached_property
    def comparison(self) -> DataFrame:
        return comparison_series(self.split, self.predictions, self.keys)


class Dashboard:
    """Key figures, trend, totals, scores and forecasts for one city (or all of them)."""

    def __init__(
        self,
        facts: DataFrame,
        city: str | None = None,
        models: Sequence[str] = ("arima", "additive"),
        horizon: int = DEFAULT_HORIZON,
        freq: str = "M",
        value: str = "Revenue",
        scale: int | None = 2,
    ):
        self.facts, self.models, self.horizon = facts, list(models), horizon
        self.freq, self.value, self.scale = freq, value, scale
        self._aggregated = to_periods(facts, (), freq, {"City": city}, value, scale=scale)

    @cached_property
    def trend(self) -> DataFrame:
        return materialize(self._aggregated, "panel")

    @cached_property
    def kpi(self) -> DataFrame:
        return summaries.kpi_row(self.trend)

    @cached_property
    def city_totals(self) -> DataFrame:
        return summaries.ranked_totals(self.facts, "City", self.value, self.scale)

    @cached_property
    def category_share(self) -> DataFrame | None:
        return summaries.category_share(self.facts, "Category", self.value, self.scale)

    @cached_property
    def scores(self) -> DataFrame:
        return metrics.score(backtest(self.trend, (), self.freq, self.models))

    @cached_property
    def forecast(self) -> DataFrame:
        return forecast(self.trend, (), self.freq, self.models, self.horizon)
