"""Hot customers: how one customer is spread over several tasks.

The running balance and the eligibility test look at all of a customer's monthly rows, and one customer
may hold a third of all rows. ``find_cuts`` looks for such customers in a sample and cuts the ordered codes of their
products into ranges of about equal rows; a customer and a range make a block, which one task works on.
Other customers stay whole, in the block ``WHOLE``, and where nobody is hot there are no blocks at all.

Sums and answers of the blocks are combined and given back (see ``series``). A cut decides only who does the
work, never the result. There are at most ``MAX_CUTS`` cuts and as many hot customers, which bounds every table of
them.
"""

from __future__ import annotations

import dataclasses
from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ebbline.options import Cuts, SeriesOptions

CUSTOMER = "CustomerID"
PRODUCT = "ProductCode"
BLOCK = "ProductBlock"
# The block of a customer who is not cut.
WHOLE = -1

# A customer with so many rows is cut, into blocks of so many rows.
HOT_ROWS = 2_000_000
BLOCK_ROWS = 1_000_000
MAX_CUTS = 4_096
# Rows looked at to find hot customers, and how many of them a hot customer has at least.
SAMPLE_ROWS = 2_000_000
LEAST_SEEN = 20


def _sampled(df: DataFrame, rows: int) -> tuple[DataFrame, float]:
    """About SAMPLE_ROWS of the ``rows`` rows, and their share."""
    share = min(1.0, SAMPLE_ROWS / max(1, rows))
    return (df if share == 1.0 else df.sample(share, seed=1)), share


def find_cuts(
    flows: DataFrame,
    customers: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    block_rows: int = BLOCK_ROWS,
    max_cuts: int = MAX_CUTS,
) -> Cuts:
    """Hot customers of transactions or daily flows, each with the codes at which its blocks begin.

    ``customers`` may name a table with a customer for about every row that is cheaper to read. Customers
    with too small a share of the sample are not found: whoever has less than ``LEAST_SEEN`` of SAMPLE_ROWS
    rows. Without hot customers the rows are counted and one column is sampled, no more.
    """
    ids = (flows if customers is None else customers).select(F.col(CUSTOMER).cast("string").alias(CUSTOMER))
    seen, share = _sampled(ids, ids.count())
    least = max(hot_rows * share, 1 if share == 1.0 else LEAST_SEEN)
    counted = seen.na.drop().groupBy(CUSTOMER).agg(F.count(F.lit(1)).alias("Rows")).where(F.col("Rows") >= least)
    hot = {r[CUSTOMER]: r["Rows"] / share for r in counted.orderBy(F.desc("Rows"), CUSTOMER).limit(max_cuts).collect()}
    if not hot:
        return ()
    of_hot = hot_table(flows.sparkSession, [(name,) for name in hot], f"{CUSTOMER} string")
    keyed = flows.select(F.col(CUSTOMER).cast("string").alias(CUSTOMER), F.col(PRODUCT).cast("string").alias(PRODUCT))
    mine, share = _sampled(keyed.na.drop().join(of_hot, CUSTOMER, "left_semi"), int(sum(hot.values())))
    # Every block gets about block_rows rows, or more where that took too many cuts.
    step = max(block_rows, sum(hot.values()) / max_cuts) * share
    by_code = W.partitionBy(CUSTOMER).orderBy(PRODUCT)
    codes = mine.groupBy(CUSTOMER, PRODUCT).agg(F.count(F.lit(1)).alias("Rows"))
    placed = codes.withColumn("Before", F.sum("Rows").over(by_code) - F.col("Rows"))
    begins = placed.withColumn("Block", F.floor(F.col("Before") / step)).groupBy(CUSTOMER, "Block").agg(F.min(PRODUCT).alias("Code"))
    listed: dict[str, list[str]] = {}
    for row in begins.where("Block > 0").orderBy(CUSTOMER, "Code").limit(max_cuts).collect():
        listed.setdefault(row[CUSTOMER], []).append(row["Code"])
    return tuple((name, tuple(cuts)) for name, cuts in listed.items())


def with_cuts(flows: DataFrame, options: SeriesOptions) -> SeriesOptions:
    """The options with hot customers looked up, unless they say who they are."""
    return options if options.cuts is not None else dataclasses.replace(options, cuts=find_cuts(flows))


def hot_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A row per hot customer or block: the size of what is broadcast here is bounded by ``MAX_CUTS``."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def with_block(monthly: DataFrame, cuts: Cuts) -> DataFrame:
    """Add the block: how many of the customer's cuts are at or below the code, ``WHOLE`` for customers without cuts.

    By binary search, for hot customers' rows alone.
    """
    longest = max(len(codes) for _, codes in cuts).bit_length()
    listed = hot_table(monthly.sparkSession, [(name, list(codes)) for name, codes in cuts], f"{CUSTOMER} string, Cuts array<string>")
    middle = "((s.low + s.high) div 2)"
    step = (
        f"IF(s.low >= s.high, s, IF(Cuts[{middle}] <= {PRODUCT}, named_struct('low', {middle} + 1, 'high', s.high),"
        f" named_struct('low', s.low, 'high', {middle})))"
    )
    start = "named_struct('low', 0L, 'high', CAST(size(Cuts) AS BIGINT))"
    found = f"aggregate(sequence(1, {longest}), {start}, (s, turn) -> {step}, s -> s.low)"
    block = F.expr(f"CAST(IF(Cuts IS NULL, {WHOLE}, {found}) AS INT)")
    return monthly.join(listed, CUSTOMER, "left").withColumn(BLOCK, block).drop("Cuts")


def per_block(df: DataFrame, cuts: Cuts) -> DataFrame:
    """Rows per customer as rows per block of a customer."""
    sizes = hot_table(df.sparkSession, [(name, len(codes)) for name, codes in cuts], f"{CUSTOMER} string, Last int")
    numbers = F.expr(f"IF(Last IS NULL, array({WHOLE}), sequence(0, Last))")
    return df.join(sizes, CUSTOMER, "left").withColumn(BLOCK, F.explode(numbers)).drop("Last")


def block_of(customer: str, code: str, cuts: Cuts) -> int:
    """The block of one row on the driver, for checks."""
    codes = dict(cuts).get(customer)
    return WHOLE if codes is None else bisect_right([c.encode() for c in codes], code.encode())


def customer_keys(df: DataFrame) -> list[str]:
    """Columns that keep a customer, or each block of a customer, in one group."""
    return [CUSTOMER, BLOCK] if BLOCK in df.columns else [CUSTOMER]


def series_keys(df: DataFrame) -> list[str]:
    """Columns of one (customer, product) series, led by the customer keys so that no extra
    shuffle is needed after grouping by those."""
    return [*customer_keys(df), PRODUCT]
