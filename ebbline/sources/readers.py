"""Table scans."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ebbline import schemas
from ebbline.functions.casts import strict_cast, text_id
from ebbline.sources import commits
from ebbline.sources.requests import Request, for_customers


@dataclass(frozen=True)
class Source:
    """Any table Spark can read: a format, its options and, for files, a path and schema.

    The format ``committed`` is parquet in the folders of a table's last commit.
    """

    format: str = "parquet"
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    schema: T.StructType | None = None

    def load(self, spark: SparkSession) -> DataFrame:
        if self.format == "committed":
            return commits.read_table(spark, self.path, self.schema)
        reader = spark.read.format(self.format).options(**self.options)
        if self.schema is not None:
            reader = reader.schema(self.schema)
        return reader.load(self.path) if self.path else reader.load()


def jdbc_source(
    url: str,
    table: str,
    partition_column: str,
    lower_bound: str,
    upper_bound: str,
    num_partitions: int,
    fetch_size: int = 10_000,
    **properties: str,
) -> Source:
    """Database table read by ``num_partitions`` tasks, each with a range of ``partition_column``.

    The column must be numeric, a date or a timestamp. Rows outside the bounds are still read, by
    the first and last task. Pass credentials as properties taken from a secret store.
    """
    return Source(
        format="jdbc",
        options={
            "url": url,
            "dbtable": table,
            "partitionColumn": partition_column,
            "lowerBound": lower_bound,
            "upperBound": upper_bound,
            "numPartitions": str(num_partitions),
            "fetchsize": str(fetch_size),
            **properties,
        },
    )


def _coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select([strict_cast(df, f.name, f.dataType) for f in schema])


def coerce_transactions(df: DataFrame, null_id_as_text: bool = True) -> DataFrame:
    """The five transaction columns with their types; text columns spell null as 'None'."""
    texts = {"CustomerID", "ProductCode", "TransType"}
    return df.select(
        [
            text_id(f.name, null_id_as_text) if f.name in texts else strict_cast(df, f.name, f.dataType)
            for f in schemas.TRANSACTIONS
        ]
    )


def coerce_features(df: DataFrame, null_id_as_text: bool = True) -> DataFrame:
    """The 33 feature columns as numbers, with blanks around source column names trimmed."""
    named = df.select([F.col(f"`{c}`").alias(c.strip()) for c in df.columns])
    return named.select(
        text_id("CustomerID", null_id_as_text),
        *[strict_cast(named, f.name, f.dataType) for f in schemas.CUSTOMER_FEATURES.fields[1:]],
    )


def scan_transactions(spark: SparkSession, source: Source, request: Request = None) -> DataFrame:
    """Transactions of all customers, or of the requested ones by a filter on the table as stored."""
    return coerce_transactions(for_customers(source.load(spark), request))


def scan_features(spark: SparkSession, source: Source, request: Request = None) -> DataFrame:
    return coerce_features(for_customers(source.load(spark), request))


def scan_budgets(spark: SparkSession, source: Source) -> DataFrame:
    return _coerce(source.load(spark), schemas.BUDGETS)


def scan_budget_transactions(spark: SparkSession, source: Source) -> DataFrame:
    return _coerce(source.load(spark), schemas.BUDGET_TRANSACTIONS)


def scan_categories(spark: SparkSession, source: Source) -> DataFrame:
    return _coerce(source.load(spark), schemas.CATEGORY_TYPES)


def scan_weekly_budget(spark: SparkSession, source: Source) -> DataFrame:
    return _coerce(source.load(spark), schemas.WEEKLY_BUDGET)


# Settings under which Spark answers a minimum or maximum of a parquet column from the files' footers.
FROM_STATISTICS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


@contextmanager
def from_statistics(spark: SparkSession) -> Iterator[None]:
    """Inside, tables that are loaded answer the bounds of ``trailing_months`` from footers, without reading a row.

    Parquet keeps usable statistics of dates, such as the days of daily flows, and not of timestamps, which are
    scanned as ever. Other jobs of the session should not run meanwhile: the settings are the session's.
    """
    before = {key: spark.conf.get(key) for key in FROM_STATISTICS}
    try:
        for key, value in FROM_STATISTICS.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def trailing_months(df: DataFrame, months: int = 3, date: str = "TransDate") -> DataFrame:
    """Rows dated from ``months`` calendar months before the latest date up to that date.

    The bounds are looked up first, one row of text, so that they reach the scan as constants. As scalar
    subqueries the two would be merged into one, whose fields no scan takes over.
    """
    newest, dtype = F.max(date), df.schema[date].dataType
    start = newest - F.make_ym_interval(F.lit(0), F.lit(months))
    bounds = df.agg(start.cast(dtype).cast("string"), newest.cast("string")).first()
    first, last = (F.lit(bound).cast(dtype) for bound in bounds)
    return df.where(F.col(date).between(first, last))


def active_budgets(budgets: DataFrame, transactions: DataFrame, months: int = 3) -> DataFrame:
    """Budgets with at least one transaction in the trailing window."""
    # Distinct ids first: a budget holding most transactions then crosses the shuffle as few rows.
    active = trailing_months(transactions, months).select("BudgetID").distinct()
    return budgets.join(active, "BudgetID", "left_semi")
