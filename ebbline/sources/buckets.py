"""Daily flows stored by customer.

A table that is scored month after month, or asked for a few customers again and again, is stored once with
the rows of a customer in one of ``buckets`` files, sorted by customer. Then the series need no shuffle of it, and a
request reads only the files that can hold its customers.

Storing is a commit (see ``commits``): it replaces the table in one step, and hot customers are looked for
while the rows are at hand. Where there are some, a bucket would be one task however large, so series of all customers
are taken from the same files without regard to buckets.
"""

from __future__ import annotations

import dataclasses
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbline import schemas
from ebbline.operators.blocks import CUSTOMER, PRODUCT, find_cuts
from ebbline.operators.flows import daily_flows
from ebbline.options import SeriesOptions
from ebbline.session import stage
from ebbline.sources import commits
from ebbline.sources.requests import INLINE_IDS, Request, for_customers, resolve

DEFAULTS = SeriesOptions()


def store_flows(
    flows: DataFrame, path: str, buckets: int, options: SeriesOptions = DEFAULTS, run: str | None = None
) -> commits.Version:
    """Store transactions, or daily flows, as daily flows by customer, in place of what ``path`` held.

    Take a bucket for about every 200 MB of daily flows; their number stays until the table is stored anew.
    """
    spark = flows.sparkSession
    daily = stage(daily_flows(flows, options).select(schemas.DAILY_FLOWS.names), "daily")
    cuts = find_cuts(daily) if options.cuts is None else options.cuts

    def write(folder: str) -> dict:
        name = _table_name(folder)
        rows = daily.repartition(buckets, CUSTOMER).sortWithinPartitions(CUSTOMER, PRODUCT, "Day")
        writer = rows.write.format("parquet").bucketBy(buckets, CUSTOMER).sortBy(CUSTOMER, PRODUCT, "Day")
        writer.option("path", folder).saveAsTable(name)
        # The files are the commit's; the name is only this session's.
        spark.sql(f"DROP TABLE {name}")
        return {"buckets": buckets, "cuts": cuts}

    return commits.publish(spark, path, write, run, keep=False)


def _table_name(folder: str) -> str:
    return f"ebbline_{folder.rsplit(commits.DATA, 1)[-1]}"


def open_flows(spark: SparkSession, path: str, by_bucket: bool = True, number: int | None = None) -> DataFrame:
    """The stored flows as of the last commit, or of the one asked for."""
    found = commits.version(spark, path, number)
    [folder] = commits.folders(spark, path, number)
    if not by_bucket:
        return spark.read.schema(schemas.DAILY_FLOWS).parquet(folder)
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schemas.DAILY_FLOWS)
    name, keys = _table_name(folder), f"{CUSTOMER}, {PRODUCT}, Day"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({CUSTOMER}) SORTED BY ({keys})"
        f" INTO {found.facts['buckets']} BUCKETS LOCATION '{folder}'"
    )
    return spark.table(name)


def open_series(
    spark: SparkSession, path: str, request: Request = None, options: SeriesOptions = DEFAULTS
) -> tuple[DataFrame, SeriesOptions]:
    """Flows to build series from, of all customers or the requested ones, and options with the stored cuts.

    What is asked for is read from its customers' buckets alone: short requests by a filter that Spark prunes
    buckets by, long ones by the files of the buckets that their ids fall into.
    """
    found = commits.version(spark, path)
    if found is None:
        raise FileNotFoundError(f"{path}: no committed version")
    cuts = tuple((name, tuple(codes)) for name, codes in found.facts["cuts"])
    asked = resolve(request)
    if asked is not None and (isinstance(asked.ids, DataFrame) or len(asked.ids) > INLINE_IDS):
        flows = _in_buckets(spark, path, asked.ids)
    else:
        flows = open_flows(spark, path, by_bucket=asked is not None or not cuts)
    return for_customers(flows, asked), dataclasses.replace(options, cuts=cuts)


def _in_buckets(spark: SparkSession, path: str, ids: DataFrame | tuple[str, ...]) -> DataFrame:
    """The flows in the buckets that the ids fall into, at most one number per bucket being collected.

    All files, joined by bucket, where ids fall into every bucket.
    """
    [folder] = commits.folders(spark, path)
    buckets = commits.version(spark, path).facts["buckets"]
    if not isinstance(ids, DataFrame):
        ids = spark.createDataFrame([(i,) for i in ids], "RequestedID string")
    # The numbers that Spark gives the buckets of a table.
    number = F.pmod(F.hash(F.col(ids.columns[0])), F.lit(buckets)).alias("bucket")
    wanted = {row["bucket"] for row in ids.select(number).distinct().collect()}
    if len(wanted) == buckets:
        return open_flows(spark, path)
    files = spark.read.format("binaryFile").load(folder).select("path").collect()
    named = {row["path"]: re.search(r"_(\d+)(?:\.c\d+)?(?:\.[a-z0-9]+)*\.parquet$", row["path"]) for row in files}
    kept = [name for name, found in named.items() if found and int(found[1]) in wanted]
    reader = spark.read.schema(schemas.DAILY_FLOWS)
    return reader.parquet(*kept) if kept else reader.parquet(folder).where("false")
