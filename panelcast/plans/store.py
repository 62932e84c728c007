"""A stored forecast table that is brought up to date instead of being rebuilt.

Rows lie in folders by model and key bucket and carry a digest of the history they were fitted on. An update
compares the digests of a panel, one aggregate over its rows, with the stored ones, fits only the series whose
history (or settings) changed, and rewrites only the folders these are in. A reader that names a model and the
keys opens one folder.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from functools import cached_property, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.models import sequence
from panelcast.operators.features import series_order
from panelcast.plans import forecasting
from panelcast.session import materialize

BUCKETS = 64
WHOLE = "_whole"


def history_digest(panel: DataFrame, keys: Sequence[str], target: str = "sales", order: str = "period") -> DataFrame:
    """``keys…, history``: a digest of each series' points. It does not depend on their order, so it is a partial
    and final aggregate without a sort; 128 bits of mixed points and their number."""
    mixed = [F.bit_xor(F.xxhash64(F.lit(seed), F.col(order), F.col(target))) for seed in (1, 2)]
    text = F.concat_ws("-", F.count(F.lit(1)).cast("string"), *(F.lower(F.hex(x)) for x in mixed))
    return panel.groupBy(*keys).agg(text.alias("history"))


class ForecastStore:
    """Forecasts of all series of a panel under ``path``, for a choice of models.

    ``options`` are those of :func:`forecasting.forecast` (season, order, band, …). A sequence model is trained
    at the first update and kept beside the table; ``retrain`` replaces it, which makes its forecasts outdated.
    One update at a time may run on a path.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str] = (),
        freq: str = "MS",
        models: Sequence[str] = ("arima", "holt_winters", "additive"),
        horizon: int = forecasting.DEFAULT_HORIZON,
        buckets: int = BUCKETS,
        **options,
    ):
        self.spark, self.path, self.freq, self.models = spark, path.rstrip("/"), freq, list(models)
        self.keys, self.own = list(keys), list(keys) or [WHOLE]
        self.horizon, self.buckets, self.options = horizon, buckets, options

    # --- layout ----------------------------------------------------------------------

    @property
    def _table(self) -> str:
        return f"{self.path}/forecasts"

    def _bucket(self, *values: Column) -> Column:
        return F.pmod(F.xxhash64(*values), F.lit(self.buckets)).cast("int")

    def _stored(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self._table)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    @cached_property
    def _sequence(self) -> sequence.SequenceModel | None:
        try:
            return forecasting.load_sequence(self.spark, f"{self.path}/sequence")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _settings(self, model: str) -> str:
        """A digest of everything but the history that a model's forecast depends on."""
        said = {"freq": self.freq, "horizon": self.horizon, **{k: str(v) for k, v in sorted(self.options.items())}}
        if model == "sequence" and self._sequence is not None:
            said["rule"] = repr(self._sequence.rule)
        return hashlib.sha256(json.dumps(said).encode()).hexdigest()[:16]

    def _wide(self, panel: DataFrame) -> DataFrame:
        return panel if self.keys else panel.withColumn(WHOLE, F.lit(0))

    # --- updates -----------------------------------------------------------------------

    def outdated(self, panel: DataFrame) -> DataFrame:
        """``model, bucket, keys…, history, change`` of every series and model to be fitted again (``new`` or
        ``changed``) or to be taken out (``gone``)."""
        now = history_digest(self._wide(panel), self.own).withColumn("bucket", self._bucket(*map(F.col, self.own)))
        settings = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(self._settings(m)).alias("settings")) for m in self.models]))
        now = now.select("*", settings.alias("_m")).select(
            F.col("_m.model").alias("model"), "bucket", *self.own, F.concat_ws("/", "history", "_m.settings").alias("history")
        )
        stored = self._stored()
        if stored is None:
            return now.withColumn("change", F.lit("new"))
        before = stored.where(F.col("ds").isNotNull() & F.col("model").isin(self.models)).select("model", "bucket", *self.own, F.col("history").alias("_before")).distinct()
        both = now.join(before, ["model", "bucket", *self.own], "full_outer")
        change = F.when(F.col("_before").isNull(), "new").when(F.col("history").isNull(), "gone")
        change = change.when(F.col("history") != F.col("_before"), "changed")
        return both.withColumn("change", change).where(F.col("change").isNotNull()).drop("_before")

    def update(self, panel: DataFrame, retrain: bool = False) -> DataFrame:
        """Bring the table up to date with ``panel`` (``keys…, period, sales``, a stored table at best, as it is read
        for the digests and for the fits); returns the stored table of changes (see :meth:`outdated`). Series that left the panel leave the table, other models' folders stay."""
        if "sequence" in self.models and (retrain or self._sequence is None):
            model = forecasting.train_sequence(panel, self.keys, **self._training())
            if model is None:
                raise ValueError("no series is long enough to train the sequence model")
            forecasting.save_sequence(model, f"{self.path}/sequence", "overwrite")
            self.__dict__.pop("_sequence", None)
        changes = materialize(self.outdated(panel), "changes")
        models = sorted(r["model"] for r in changes.select("model").distinct().collect())
        if not models:
            return changes
        fresh = [self._fitted(panel, changes.where(F.col("model") == m), m) for m in models]
        rows = reduce(DataFrame.unionByName, fresh)
        stored, folders = self._stored(), changes.select("model", "bucket").distinct()
        if stored is not None:
            touched = stored.where(F.col("ds").isNotNull()).join(folders, ["model", "bucket"], "left_semi")
            kept = touched.join(changes, ["model", "bucket", *self.own], "left_anti")
            rows = rows.unionByName(kept.select(*rows.columns))
        # A row without a date keeps a folder that would be left as it is for want of rows.
        marks = folders.select("model", "bucket", *(F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns if c not in ("model", "bucket")))
        rows = materialize(rows.unionByName(marks), "updated")
        spread = rows.repartition("model", "bucket").sortWithinPartitions("model", "bucket", *self.own, "ds")
        spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model", "bucket").parquet(self._table)
        return changes

    def _training(self) -> dict:
        names = {"sequence_kind": "kind", "length": "length", "calendar": "calendar"}
        return {names[k]: v for k, v in self.options.items() if k in names}

    def _fitted(self, panel: DataFrame, changes: DataFrame, model: str) -> DataFrame:
        """New rows of one model, fitted on the changed series alone."""
        wanted = changes.where(F.col("change") != "gone").select(*self.own, "history", "bucket")
        own = self._wide(panel).join(wanted, self.own, "left_semi")
        options = {"sequence_model": self._sequence} if model == "sequence" else {}
        rows = forecasting.forecast(own, self.own, self.freq, [model], self.horizon, **self.options, **options)
        return rows.join(wanted, self.own).select(*self.own, "history", "variant", "ds", "yhat", "yhat_lower", "yhat_upper", "model", "bucket")

    # --- reading -----------------------------------------------------------------------

    def read(self, models: Sequence[str] | None = None, **where) -> DataFrame:
        """``keys…, model, variant, ds, yhat, yhat_lower, yhat_upper``, of some models or of one value per key. Naming
        all keys opens only the folders of their bucket. Raises where nothing was stored."""
        stored = self._stored()
        if stored is None:
            raise FileNotFoundError(f"no forecasts under {self.path!r}")
        if unknown := set(where) - set(self.keys):
            raise ValueError(f"{sorted(unknown)} are no keys of {self.keys}")
        rows = stored.where(F.col("ds").isNotNull())
        if models is not None:
            rows = rows.where(F.col("model").isin(list(models)))
        values = {k: F.lit(v).cast(stored.schema[k].dataType) for k, v in where.items()}
        for k, v in values.items():
            rows = rows.where(F.col(k) == v)
        if self.keys and set(values) == set(self.keys):
            rows = rows.where(F.col("bucket") == self._bucket(*(values[k] for k in self.keys)))
        return rows.select(*self.keys, "model", "variant", "ds", "yhat", "yhat_lower", "yhat_upper")

    def next_periods(self, n: int = 1, models: Sequence[str] | None = None, **where) -> DataFrame:
        """The first ``n`` forecast periods of every series and model."""
        rows = self.read(models, **where).withColumn("step", F.row_number().over(series_order([*self.keys, "model"], "ds")))
        return rows.where(F.col("step") <= n)
