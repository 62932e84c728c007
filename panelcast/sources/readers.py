"""Fact-table readers and date construction."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelcast.functions import parsing
from panelcast.operators.roles import detect_date_column, rename_date_role

NUMERIC_ROLES = ("Revenue", "Sales", "Units_Sold", "Unit_Price")
MALFORMED = "_malformed"
#: Why a row has no date, in the order in which they are looked for.
REASONS = ("malformed", "missing", "unreadable", "out_of_range")


def read_csv_facts(spark: SparkSession, path: str, multiline: bool = False, malformed: bool = False) -> DataFrame:
    """Every CSV under ``path`` (a folder or a file), all columns as text.

    Text avoids a schema-inference pass over the data; roles are cast where they are used.
    ``multiline`` allows line breaks inside quotes, at the price of one task per file. ``malformed``
    adds the text of records with too many or too few fields as column ``_malformed``.
    Raises when the path holds no file ending in ``.csv``.
    """
    reader = spark.read.options(
        header=True, inferSchema=False, enforceSchema=False, escape='"', multiLine=multiline, pathGlobFilter="*.csv"
    )
    try:
        found = reader.csv(path)
        if not malformed:
            return found
        # The schema of the header line, and a column for the records that do not fit it. Whether one fits is
        # seen only if all its fields are read.
        columns = StructType([*found.schema.fields, StructField(MALFORMED, StringType())])
        return reader.options(columnNameOfCorruptRecord=MALFORMED, columnPruning=False).schema(columns).csv(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"no CSV file found in {path!r}") from error
        raise


def read_parquet_facts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def with_dates(
    df: DataFrame,
    mode: str = "permissive",
    date_col: str | None = None,
    legacy_dayfirst: bool = False,
) -> DataFrame:
    """Add ``date`` (and ``month_num`` where it is built from parts); bad dates stay null.

    Month+Year wins over Quarter+Year, which wins over a detected date column; an explicit
    ``date_col`` overrides all three. ``mode='strict'`` fails the query on an unreadable
    month, quarter or year instead of leaving a null.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError("mode is 'strict' or 'permissive'")
    if date_col is None and {"Month", "Year"} <= set(df.columns):
        df = df.withColumn("month_num", parsing.month_number(F.col("Month")))
        return _date_from_parts(df, "Month", mode)
    if date_col is None and {"Quarter", "Year"} <= set(df.columns):
        df = df.withColumn("month_num", parsing.quarter_month(F.col("Quarter")))
        return _date_from_parts(df, "Quarter", mode)
    source = date_col or detect_date_column(df.columns)
    kind = df.schema[source].dataType.simpleString()
    if kind in ("date", "timestamp", "timestamp_ntz"):
        parsed: Column = F.col(source)
    else:
        parsed = parsing.free_date(F.col(source), legacy_dayfirst)
    return rename_date_role(df.withColumn(source, parsed), source)


def _date_from_parts(df: DataFrame, part: str, mode: str) -> DataFrame:
    date = parsing.first_of_month(F.col("Year"), F.col("month_num"))
    if mode == "strict":
        shown = F.concat_ws(" ", F.col(part).cast("string"), F.col("Year").cast("string"))
        date = F.coalesce(date, F.raise_error(F.concat(F.lit(f"unreadable {part}/Year: "), shown)).cast("date"))
    return df.withColumn("date", date)


READERS = {"csv": read_csv_facts, "parquet": read_parquet_facts}


def load_sales(
    spark: SparkSession,
    path: str,
    mode: str = "permissive",
    date_col: str | None = None,
    sales_col: str | None = None,
    legacy_dayfirst: bool = False,
    source: str = "csv",
) -> DataFrame:
    """Fact table with ``date`` from CSV or Parquet; rows without a date are dropped.

    The rows dropped are available as ``rejected_rows`` of the same arguments; ``observed_sales`` counts
    them by reason in the same pass.
    """
    facts = with_dates(READERS[source](spark, path), mode, date_col, legacy_dayfirst)
    if source == "csv":
        facts = _numeric(facts, sales_col)
    return facts.where(F.col("date").isNotNull())


class LoadReport:
    """What a load kept and dropped, counted while the facts pass by: no file is read for it.

    The counts are those of the first action on the facts, and waiting for them lasts until one has run.
    """

    def __init__(self):
        self._seen = Observation()

    def counts(self) -> dict[str, int]:
        """``n_rows, n_kept``, dropped rows by reason (``rejected_…``), ``kept_malformed`` records (kept because
        they have a date) and ``unreadable_amounts`` (amounts that are no number, null in the facts)."""
        return {k: int(v or 0) for k, v in self._seen.get.items()}

    def watch(self, df: DataFrame, amounts: Column) -> DataFrame:
        def total(condition: Column) -> Column:
            return F.coalesce(F.sum(condition.cast("long")), F.lit(0))

        reason, kept = F.col("reject_reason"), F.col("reject_reason").isNull()
        return df.observe(
            self._seen,
            F.count(F.lit(1)).alias("n_rows"),
            total(kept).alias("n_kept"),
            *[F.coalesce(total(reason == r), F.lit(0)).alias(f"rejected_{r}") for r in REASONS],
            total(kept & F.col(MALFORMED).isNotNull()).alias("kept_malformed"),
            total(kept & amounts).alias("unreadable_amounts"),
        )


def reject_reason(df: DataFrame, date_col: str | None = None) -> Column:
    """Why a row of :func:`with_dates` has no date (null where it has one): ``malformed`` records, ``missing`` parts
    (null or blank), ``unreadable`` ones, or a month or year ``out_of_range``. ``df`` is the table before."""

    def blank(name: str) -> Column:
        return F.coalesce(F.trim(F.col(name).cast("string")), F.lit("")) == ""

    part = next((p for p in ("Month", "Quarter") if date_col is None and {p, "Year"} <= set(df.columns)), None)
    if part:
        number = parsing.month_number(F.col(part)) if part == "Month" else parsing.quarter_month(F.col(part))
        missing, unreadable = blank(part) | blank("Year"), number.isNull() | parsing.to_whole(F.col("Year")).isNull()
    else:
        missing, unreadable = blank(date_col or detect_date_column(df.columns)), F.lit(True)
    reason = F.when(F.col(MALFORMED).isNotNull(), "malformed") if MALFORMED in df.columns else F.when(F.lit(False), "malformed")
    return reason.when(missing, "missing").when(unreadable, "unreadable").otherwise("out_of_range")


def labelled_sales(
    spark: SparkSession,
    path: str,
    date_col: str | None = None,
    sales_col: str | None = None,
    legacy_dayfirst: bool = False,
    source: str = "csv",
    report: LoadReport | None = None,
) -> DataFrame:
    """All rows of :func:`load_sales` with ``reject_reason``, null for those it keeps. One scan gives the facts, the
    dropped rows and, with ``report``, their numbers."""
    raw = read_csv_facts(spark, path, malformed=True) if source == "csv" else READERS[source](spark, path)
    if MALFORMED not in raw.columns:
        raw = raw.withColumn(MALFORMED, F.lit(None).cast("string"))
    why = reject_reason(raw, date_col)
    marked = with_dates(raw.withColumn("_why", why), "permissive", date_col, legacy_dayfirst)
    marked = marked.withColumn("reject_reason", F.when(F.col("date").isNull(), F.col("_why"))).drop("_why")
    amounts = F.lit(False)
    if source == "csv":
        wanted = [c for c in marked.columns if c in NUMERIC_ROLES or c == sales_col]
        for c in wanted:
            text = F.col(c).cast("string")
            amounts = amounts | ((F.trim(text) != "") & parsing.to_number(text).isNull())
        marked = marked.withColumn("_amounts", F.coalesce(amounts, F.lit(False)))
        marked = _numeric(marked, sales_col)
        amounts = F.col("_amounts")
    if report is not None:
        marked = report.watch(marked, amounts)
    return marked.drop("_amounts", MALFORMED)


def observed_sales(spark: SparkSession, path: str, **options) -> tuple[DataFrame, LoadReport]:
    """The facts of :func:`load_sales` and the report of what their first action drops. ``options`` are those of
    :func:`labelled_sales`."""
    report = LoadReport()
    facts = labelled_sales(spark, path, report=report, **options)
    return facts.where(F.col("reject_reason").isNull()).drop("reject_reason"), report


def rejected_rows(
    spark: SparkSession,
    path: str,
    date_col: str | None = None,
    legacy_dayfirst: bool = False,
    source: str = "csv",
) -> DataFrame:
    """The rows ``load_sales`` drops because no date could be built."""
    facts = with_dates(READERS[source](spark, path), "permissive", date_col, legacy_dayfirst)
    return facts.where(F.col("date").isNull())


def _numeric(df: DataFrame, sales_col: str | None) -> DataFrame:
    wanted = [c for c in df.columns if c in NUMERIC_ROLES or c == sales_col]
    casts = {c: parsing.to_number(F.col(c)) for c in wanted}
    if "Year" in df.columns:
        casts["Year"] = parsing.to_whole(F.col("Year"))
    return df.withColumns(casts) if casts else df
