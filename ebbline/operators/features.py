"""Customer features.

``flow_features`` computes, from transactions, the columns the feature table is expected to hold.
Their definitions are read off the column names; where a real feature table exists, scan that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ebbline import schemas
from ebbline.operators.blocks import BLOCK, CUSTOMER, customer_keys, per_block
from ebbline.operators.flows import SIDES, customer_days
from ebbline.options import Cuts, SeriesOptions

DEFAULTS = SeriesOptions()


def period_flows(days: DataFrame) -> DataFrame:
    """Customer days summed to periods, numbered within their Grain: the four weeks of the month
    ('slot'), calendar weeks from Monday ('week') and months ('month').

    Days are first brought together by customer, who has no more of them than the calendar holds.
    Unlike grouping sets, exploding the periods keeps that grouping, so this sum and the one per
    customer after it need no shuffle of their own.
    """
    periods = """inline(array(
        struct('slot' AS Grain, CAST(least(4, floor((day(Day) - 1) / 7) + 1) AS INT) AS Period),
        struct('week' AS Grain, unix_date(next_day(Day, 'MON')) AS Period),
        struct('month' AS Grain, year(Day) * 12 + month(Day) AS Period)))"""
    flows = [f"{side}{what}" for side in SIDES for what in ("Sum", "Count")]
    return (
        days.repartition(CUSTOMER)
        .selectExpr(CUSTOMER, *flows, periods)
        .groupBy(CUSTOMER, "Grain", "Period")
        .agg(
            *[F.expr(f"CAST(sum({side}Sum) AS DOUBLE)").alias(f"{side}Sum") for side in SIDES],
            *[F.expr(f"sum({side}Count)").alias(f"{side}Count") for side in SIDES],
        )
    )


def _median(array: str) -> str:
    """SQL for the median of a sorted array: the mean of its two middle values, or twice the same one."""
    return f"(get({array}, (size({array}) - 1) div 2) + get({array}, size({array}) div 2)) / 2"


def flow_features(flows: DataFrame, options: SeriesOptions = DEFAULTS) -> DataFrame:
    """Weekly, monthly and week-of-month statistics per customer, from transactions or daily flows.

    A customer's totals and counts are gathered in sorted arrays, a value per week or month, which the
    calendar keeps short; smallest, greatest and median are read off by position. Written as SQL
    expressions, which spare the driver a call per column operation.
    """
    gathered, cells = {}, {}
    for side in SIDES:
        total, count = f"coalesce({side}Sum, 0D)", f"{side}Count"
        for slot in range(1, 5):
            name = f"Week_{slot}_Avg_{side}"
            here = f"FILTER (WHERE Grain = 'slot' AND Period = {slot})"
            gathered[name] = f"max({side}Sum / nullif({count}, 0)) {here}"
            cells[name] = name
        for name, grain in (("Weekly", "week"), ("Monthly", "month")):
            here = f"FILTER (WHERE Grain = '{grain}')"
            totals, counts, variance = f"{name}_{side}", f"{name}_Count_{side}", f"{name}_Count_Variance_{side}"
            gathered[totals] = f"sort_array(collect_list({total}) {here})"
            gathered[counts] = f"sort_array(collect_list({count}) {here})"
            gathered[variance] = f"var_samp({count}) {here}"
            cells[f"{name}_Min_{side}"] = f"get({totals}, 0)"
            cells[f"{name}_Max_{side}"] = f"get({totals}, size({totals}) - 1)"
            cells[f"{name}_Median_{side}"] = _median(totals)
            cells[f"{name}_Count_Median_{side}"] = _median(counts)
            cells[variance] = variance
    # The last two months, newest first, give the change.
    month = "struct(Period, coalesce(CreditSum, 0D) AS Credit, coalesce(DebitSum, 0D) AS Debit)"
    months = f"collect_list({month}) FILTER (WHERE Grain = 'month')"
    gathered["Months"] = f"slice(sort_array({months}, false), 1, 2)"
    for side in SIDES:
        last, base = f"get(Months, 0).{side}", f"get(Months, 1).{side}"
        cells[f"Last_Month_PCT_CH_{side}"] = f"({last} - {base}) / nullif({base}, 0D)"
    return (
        period_flows(customer_days(flows, options))
        .groupBy(CUSTOMER)
        .agg(*[F.expr(f"{cell} AS {name}") for name, cell in gathered.items()])
        .selectExpr(CUSTOMER, *[f"{cell} AS {name}" for name, cell in cells.items()])
    )


def customer_features(profiles: DataFrame, flows: DataFrame, options: SeriesOptions = DEFAULTS) -> DataFrame:
    """The 33-column feature table: profile columns plus flow features, 0 where there is none."""
    joined = profiles.join(flow_features(flows, options), CUSTOMER, "left")
    from_flows = schemas.FEATURE_COLUMNS[2:-1]
    filled = [f"coalesce(CAST({name} AS DOUBLE), 0D) AS {name}" for name in from_flows]
    return joined.selectExpr(CUSTOMER, "Age", *filled, "SegmentID")


def require_unique(df: DataFrame, key: str = CUSTOMER) -> DataFrame:
    """``df`` unchanged, failing the job when a key occurs twice."""
    copies = F.count(F.lit(1)).over(W.partitionBy(key))
    message = F.concat(F.lit(f"duplicate {key}: "), F.col(key))
    checked = F.when(F.col("Copies") > 1, F.raise_error(message).cast("string")).otherwise(F.col(key))
    return df.withColumn("Copies", copies).withColumn(key, checked).drop("Copies")


def latest_per_key(df: DataFrame, *order: str, key: str = CUSTOMER) -> DataFrame:
    """One row per key: the greatest by ``order``, which should leave no ties."""
    rank = F.row_number().over(W.partitionBy(key).orderBy(*[F.desc(c) for c in order]))
    return df.withColumn("Rank", rank).where(F.col("Rank") == 1).drop("Rank")


def attach_features(series: DataFrame, features: DataFrame, cuts: Cuts = ()) -> DataFrame:
    """Inner join on the customer. Series without features drop out; duplicate feature rows multiply.

    Both sides are already grouped by customer. Where hot customers are cut, their features, a few rows, are
    copied to each of their blocks, so that a big customer's rows stay spread out.
    """
    keys = customer_keys(series)
    if len(keys) > 1:
        features = per_block(features, cuts)
    return series.join(features, keys, "inner").drop(BLOCK)
