"""Monthly balance series per customer and product.

Work is done on two shuffles: the monthly sums, combined before they move, and one grouping of the
monthly rows by customer that serves every window below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ebbline.functions.cells import non_negative_flag, struggle_flag
from ebbline.operators.blocks import BLOCK, CUSTOMER, PRODUCT, WHOLE, customer_keys, series_keys, with_block, with_cuts
from ebbline.operators.flows import monthly_flows
from ebbline.options import SeriesOptions
from ebbline.session import stage

DEFAULTS = SeriesOptions()


def running_balance(monthly: DataFrame, options: SeriesOptions = DEFAULTS) -> DataFrame:
    """Add Balance: net flow summed over the customer's rows in order of product, then month.

    The sum runs on from one product into the next, so a product opens at the closing balance of
    the product before it. Where there are hot customers, rows also get their block, which the functions below
    group by; ``balance_series`` and what builds on it take that column off again.
    """
    net = F.col("Credit") - F.col("Debit")
    if not options.cuts:
        rows_so_far = W.partitionBy(CUSTOMER).orderBy(PRODUCT, "Date").rowsBetween(W.unboundedPreceding, 0)
        return monthly.withColumn("Balance", F.sum(net).over(rows_so_far))

    # Sums within each block, to which is added what the customer's earlier blocks come to: a row per block of
    # a hot customer, whose number is bounded, so that the blocks' openings are broadcast. The rows are
    # read three times from here on, hence the staging.
    blocked = stage(with_block(monthly, options.cuts), "monthly")
    earlier_blocks = W.partitionBy(CUSTOMER).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    opening = (
        blocked.where(F.col(BLOCK) != WHOLE)
        .groupBy(CUSTOMER, BLOCK)
        .agg(F.sum(net).alias("BlockNet"))
        .select(CUSTOMER, BLOCK, F.sum("BlockNet").over(earlier_blocks).alias("Opening"))
    )
    block_so_far = W.partitionBy(CUSTOMER, BLOCK).orderBy(PRODUCT, "Date").rowsBetween(W.unboundedPreceding, 0)
    balance = F.sum(net).over(block_so_far) + F.coalesce("Opening", F.lit(0))
    return (
        blocked.join(F.broadcast(opening), [CUSTOMER, BLOCK], "left")
        .withColumn("Balance", balance.cast("decimal(38,2)"))
        .drop("Opening")
    )


def positive_month_counts(balances: DataFrame) -> DataFrame:
    """Months without a negative balance per customer and product."""
    return balances.groupBy(CUSTOMER, PRODUCT).agg(
        F.sum(non_negative_flag(F.col("Balance"))).alias("PositiveMonths")
    )


def eligible_series(balances: DataFrame, options: SeriesOptions = DEFAULTS) -> DataFrame:
    """All products of every customer with a product of exactly ``positive_months`` such months."""
    months = F.sum(non_negative_flag(F.col("Balance"))).over(W.partitionBy(*series_keys(balances)))
    counted = balances.withColumn("PositiveMonths", months)
    qualifies = F.col("PositiveMonths") == options.positive_months
    answered = counted.withColumn("Eligible", F.max(qualifies).over(W.partitionBy(*customer_keys(balances))))
    if BLOCK in balances.columns:
        # A block answers for the others of its customer: a row per hot customer at most.
        hits = counted.where((F.col(BLOCK) != WHOLE) & qualifies).select(CUSTOMER).distinct().withColumn("Hit", F.lit(True))
        answered = answered.join(F.broadcast(hits), CUSTOMER, "left")
        answered = answered.withColumn("Eligible", F.col("Eligible") | F.coalesce("Hit", F.lit(False)))
    return answered.where("Eligible").select(*balances.columns)


def _in_series(df: DataFrame):
    return W.partitionBy(*series_keys(df)).orderBy("Date")


def previous_mean(series: DataFrame, options: SeriesOptions = DEFAULTS) -> DataFrame:
    """Add PrevMean: mean balance of the preceding rows of the series, null until there are enough.

    Rows count, not calendar months: a missing month is not made up.
    """
    before = _in_series(series).rowsBetween(-options.mean_rows, -1)
    enough = F.count("Balance").over(before) == options.mean_rows
    mean = F.sum("Balance").over(before).cast("double") / options.mean_rows
    return series.withColumn("PrevMean", F.when(enough, mean))


def with_previous_mean(series: DataFrame, options: SeriesOptions = DEFAULTS) -> DataFrame:
    """Add Prev_Mean_Bal: the previous mean, 0 where undefined."""
    filled = F.coalesce("PrevMean", F.lit(0.0)).alias("Prev_Mean_Bal")
    return previous_mean(series, options).select(*series.columns, filled)


def with_labels(series: DataFrame, options: SeriesOptions = DEFAULTS) -> DataFrame:
    """Add Prev_Mean_Bal, Struggle and the label Struggle_shifted, the next row's Struggle.

    Struggle looks at the mean before it is filled, so it is 0 while the mean is undefined. The
    first rows of a product therefore never struggle, and reading the label inside the series
    equals reading it across a customer's products.
    """
    flag = struggle_flag(F.col("Balance"), F.col("PrevMean"), options.drop_ratio)
    flagged = previous_mean(series, options).withColumn("Struggle", flag)
    following = F.lead("Struggle").over(_in_series(flagged))
    labelled = flagged.withColumn("Struggle_shifted", following)
    if options.drop_unknown:
        labelled = labelled.where(F.col("Struggle_shifted").isNotNull())
    return labelled.select(
        *series.columns,
        F.coalesce("PrevMean", F.lit(0.0)).alias("Prev_Mean_Bal"),
        "Struggle",
        F.coalesce("Struggle_shifted", F.lit(0)).alias("Struggle_shifted"),
    )


def latest_rows(series: DataFrame) -> DataFrame:
    """Last row of every (customer, product): the one with no row after it."""
    following = F.lead("Date").over(_in_series(series))
    return series.withColumn("Following", following).where(F.col("Following").isNull()).drop("Following")


def next_month(series: DataFrame) -> DataFrame:
    """Move Date on by one calendar month. The day is kept where the month has it: 28 Feb becomes
    28 Mar, 31 Jan becomes 28 or 29 Feb."""
    return series.withColumn("Date", F.add_months("Date", 1))


def _eligible_balances(flows: DataFrame, options: SeriesOptions) -> DataFrame:
    options = with_cuts(flows, options)
    return eligible_series(running_balance(monthly_flows(flows, options), options), options)


def balance_series(flows: DataFrame, options: SeriesOptions = DEFAULTS) -> DataFrame:
    """Transactions, or daily flows, to eligible series with their running balance."""
    return _eligible_balances(flows, options).drop(BLOCK)


def labelled_series(flows: DataFrame, options: SeriesOptions = DEFAULTS, keep_blocks: bool = False) -> DataFrame:
    """Training side: every row of the eligible series with its label."""
    rows = with_labels(_eligible_balances(flows, options), options)
    return rows if keep_blocks else rows.drop(BLOCK)


def forecast_series(flows: DataFrame, options: SeriesOptions = DEFAULTS, keep_blocks: bool = False) -> DataFrame:
    """Scoring side: the last row of each eligible series, dated one month on."""
    rows = next_month(latest_rows(with_previous_mean(_eligible_balances(flows, options), options)))
    return rows if keep_blocks else rows.drop(BLOCK)
