import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import brute
from ebbline.operators import blocks, features, flows, series
from ebbline.options import SeriesOptions

COLUMNS = [
    "CustomerID", "ProductCode", "Date", "Credit", "Debit", "Balance", "Prev_Mean_Bal", "Struggle", "Struggle_shifted",
]


def golden_rows():
    rows = [("1", "A", 100, f"2023-{m:02d}-15", "C") for m in range(1, 9) if m != 5]
    rows += [("1", "A", 250, "2023-05-20", "D"), ("1", "B", 50, "2023-01-15", "C"), ("1", "B", 700, "2023-02-20", "D")]
    rows += [("2", "A", 10, f"2023-{m:02d}-15", "C") for m in range(1, 10)]
    rows += [("3", "A", 10, "2023-01-20", "D")] + [("3", "A", 50, f"2023-{m:02d}-15", "C") for m in range(2, 10)]
    return rows


# Customer, product, date, credit, debit, balance, previous mean, struggle, label.
GOLDEN = """
1 A 2023-01-31 100 0 100 0 0 0
1 A 2023-02-28 100 0 200 0 0 0
1 A 2023-03-31 100 0 300 0 0 0
1 A 2023-04-30 100 0 400 200 0 1
1 A 2023-05-31 0 250 150 300 1 0
1 A 2023-06-30 100 0 250 283.333333 0 0
1 A 2023-07-31 100 0 350 266.666667 0 0
1 A 2023-08-31 100 0 450 250 0 0
1 B 2023-01-31 50 0 500 0 0 0
1 B 2023-02-28 0 700 -200 0 0 0
3 A 2023-01-31 0 10 -10 0 0 0
3 A 2023-02-28 50 0 40 0 0 0
3 A 2023-03-31 50 0 90 0 0 0
3 A 2023-04-30 50 0 140 40 0 0
3 A 2023-05-31 50 0 190 90 0 0
3 A 2023-06-30 50 0 240 140 0 0
3 A 2023-07-31 50 0 290 190 0 0
3 A 2023-08-31 50 0 340 240 0 0
3 A 2023-09-30 50 0 390 290 0 0
"""


def collected(df):
    return sorted(tuple(row) for row in df.select(COLUMNS).collect())


def random_rows(seed, customers=12, products=4, n=1500):
    rng = random.Random(seed)
    start = dt.datetime(2021, 1, 1)
    return [
        (
            rng.choice([*map(str, range(customers)), None]),
            rng.choice([f"P{i}" for i in range(products)] + [None, "é", "Z"]),
            rng.choice([None, round(rng.uniform(0, 500), 2), 0]),
            rng.choice([None] + [(start + dt.timedelta(hours=rng.randrange(24 * 500))).isoformat()] * 20),
            rng.choice(["C", "C", "D", "D", "X", None]),
        )
        for _ in range(n)
    ]


def named_nulls(df):
    """The scan's treatment of null keys."""
    return df.withColumns({c: F.coalesce(c, F.lit("None")) for c in ("CustomerID", "ProductCode", "TransType")})


def test_golden_series(transactions):
    found = collected(series.labelled_series(transactions(golden_rows())))
    expected = [line.split() for line in GOLDEN.strip().splitlines()]
    assert [(r[0], r[1], str(r[2])) for r in found] == [tuple(e[:3]) for e in expected]
    for row, line in zip(found, expected):
        assert [float(v) for v in row[3:]] == pytest.approx([float(v) for v in line[3:]], abs=1e-6)


def test_golden_forecast(transactions):
    found = series.forecast_series(transactions(golden_rows())).select("CustomerID", "ProductCode", "Date").collect()
    assert sorted((c, p, str(d)) for c, p, d in found) == [
        ("1", "A", "2023-09-30"), ("1", "B", "2023-03-28"), ("3", "A", "2023-10-30"),
    ]


@pytest.mark.parametrize("months", [3, 8])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(transactions, seed, months):
    rows = random_rows(seed)
    df = transactions(rows)
    parsed = [tuple(r) for r in df.collect()]
    found = collected(series.labelled_series(named_nulls(df), SeriesOptions(positive_months=months)))
    expected = brute.labelled(parsed, months)
    assert len(found) == len(expected) and found
    assert [r[:6] + r[7:] for r in found] == [r[:6] + r[7:] for r in expected]
    assert [r[6] for r in found] == pytest.approx([r[6] for r in expected], abs=1e-9)


def test_blocks_give_the_same_series(transactions):
    df = named_nulls(transactions(random_rows(3, customers=6, products=30, n=4000)))
    plain = SeriesOptions(positive_months=2)
    whole = series.labelled_series(df, plain)
    # To single products, to a few blocks, only the larger customers, in two.
    for hot_rows, block_rows in ((1, 1), (1, 100), (560, 200), (1, 400)):
        cuts = blocks.find_cuts(df, hot_rows=hot_rows, block_rows=block_rows)
        assert cuts
        cut = series.labelled_series(df, SeriesOptions(positive_months=2, cuts=cuts))
        assert collected(cut) == collected(whole)
    latest = series.forecast_series(df, SeriesOptions(positive_months=2, cuts=cuts))
    columns = latest.columns
    assert sorted(map(tuple, latest.collect())) == sorted(
        map(tuple, series.forecast_series(df, plain).select(columns).collect())
    )


def test_daily_flows_give_the_same_series_and_features(spark, transactions):
    df = named_nulls(transactions(random_rows(6)))
    daily = flows.daily_flows(df)
    options = SeriesOptions(positive_months=3)
    assert collected(series.labelled_series(daily, options)) == collected(series.labelled_series(df, options))
    direct, through_days = features.flow_features(df), features.flow_features(daily)
    for one, other in zip(direct.orderBy("CustomerID").collect(), through_days.orderBy("CustomerID").collect(), strict=True):
        assert one["CustomerID"] == other["CustomerID"]
        # Variances are added up in no fixed order, so the last digit may differ.
        assert list(one[1:]) == [None if v is None else pytest.approx(v, rel=1e-12) for v in other[1:]]


def test_row_order_and_partitioning_do_not_matter(transactions):
    rows = random_rows(4, n=600)
    options = SeriesOptions(positive_months=2)
    first = collected(series.labelled_series(named_nulls(transactions(rows)), options))
    random.Random(0).shuffle(rows)
    assert collected(series.labelled_series(named_nulls(transactions(rows).repartition(7)), options)) == first


def test_a_customer_is_kept_whole_or_not_at_all(transactions):
    df = named_nulls(transactions(random_rows(5)))
    options = SeriesOptions(positive_months=3)
    balances = series.running_balance(flows.monthly_flows(df, options), options)
    every = balances.groupBy("CustomerID").count()
    kept = series.eligible_series(balances, options).groupBy("CustomerID").count().withColumnRenamed("count", "kept")
    assert kept.join(every, "CustomerID").where("kept <> count").count() == 0


@pytest.mark.parametrize("months, kept", [(7, False), (8, True), (9, False)])
def test_exactly_eight_positive_months(transactions, months, kept):
    df = transactions([("1", "A", 5, f"2023-{m:02d}-10", "C") for m in range(1, months + 1)])
    assert bool(collected(series.labelled_series(df))) == kept


def test_zero_balance_counts_as_positive(transactions):
    rows = [("1", "A", 5, "2023-01-10", "C"), ("1", "A", 5, "2023-02-10", "D")]
    counts = series.positive_month_counts(series.running_balance(flows.monthly_flows(transactions(rows))))
    assert counts.first()["PositiveMonths"] == 2


def test_null_amounts_add_nothing_and_undated_rows_are_left_out(transactions):
    rows = [("1", "A", None, "2023-01-10", "C"), ("1", "A", 7, None, "C"), ("1", "A", 3, "2023-02-10", "D")]
    found = flows.monthly_flows(transactions(rows)).orderBy("Date").collect()
    assert [(float(r["Credit"]), float(r["Debit"])) for r in found] == [(0, 0), (0, 3)]


def test_rows_without_keys_are_left_out_with_and_without_blocks(transactions):
    rows = [(c, p, 5, f"2023-{m:02d}-10", "C") for m in (1, 2) for c in ("1", None) for p in ("A", "B", None)]
    whole = series.labelled_series(transactions(rows), SeriesOptions(positive_months=2))
    cut = series.labelled_series(transactions(rows), SeriesOptions(positive_months=2, cuts=(("1", ("B",)),)))
    assert collected(whole) == collected(cut) and {r[:2] for r in collected(whole)} == {("1", "A"), ("1", "B")}


def test_unexpected_types_are_set_aside(transactions):
    rows = [("1", "A", 1, "2023-01-10", "C"), ("1", "A", 2, "2023-01-10", "X")]
    df = transactions(rows)
    assert [float(r["TransAmount"]) for r in flows.unexpected_types(df).collect()] == [2]
    assert float(flows.monthly_flows(df).first()["Credit"]) == 1


def test_types_by_position(transactions):
    rows = [("1", "A", 1, "2023-01-10", "in"), ("1", "A", 2, "2023-01-10", "out"), ("1", "A", 2, "2023-01-11", "in")]
    assert flows.detect_types(transactions(rows)) == ("in", "out")
    credit, debit = flows.detect_types(transactions(rows))
    row = flows.monthly_flows(transactions(rows), SeriesOptions(credit_type=credit, debit_type=debit)).first()
    assert (float(row["Credit"]), float(row["Debit"])) == (3, 2)
    for wrong in (rows[:1], [*rows, ("1", "A", 2, "2023-01-10", "x")]):
        with pytest.raises(ValueError, match="two transaction types"):
            flows.detect_types(transactions(wrong))


def test_products_sort_as_text(transactions):
    """Product 10 comes before product 9, so 9 opens at the balance of 10."""
    rows = [("1", "9", 1, "2023-01-10", "C"), ("1", "10", 100, "2023-01-10", "C")]
    found = series.running_balance(flows.monthly_flows(transactions(rows)))
    assert {r["ProductCode"]: float(r["Balance"]) for r in found.collect()} == {"10": 100, "9": 101}


def test_negative_mean_moves_the_threshold_up(transactions):
    """With a mean of -100 the threshold is -70, so -80 is a struggle."""
    rows = [("1", "A", 100, "2023-01-10", "D")]
    rows += [("1", "A", 0, f"2023-{m:02d}-10", "D") for m in (2, 3)] + [("1", "A", 20, "2023-04-10", "C")]
    rows += [("1", "B", 500, f"2023-{m:02d}-10", "C") for m in range(1, 9)]
    found = collected(series.labelled_series(transactions(rows)))
    assert [r[7] for r in found if r[1] == "A"] == [0, 0, 0, 1]
    assert [r[8] for r in found if r[1] == "A"] == [0, 0, 1, 0]


def test_missing_months_are_not_made_up(transactions):
    rows = [("1", "A", 10, d, "C") for d in ("2020-01-10", "2021-05-10", "2022-02-10", "2023-09-10")]
    found = collected(series.labelled_series(transactions(rows), SeriesOptions(positive_months=4)))
    assert [r[6] for r in found] == [0, 0, 0, 20]


def test_last_month_can_be_dropped(transactions):
    kept = collected(series.labelled_series(transactions(golden_rows()), SeriesOptions(drop_unknown=True)))
    last = {("1", "A", "2023-08-31"), ("1", "B", "2023-02-28"), ("3", "A", "2023-09-30")}
    assert len(kept) == 16 and not last & {(r[0], r[1], str(r[2])) for r in kept}


def test_next_month_keeps_the_day_where_it_exists(spark):
    dates = spark.createDataFrame([(dt.date(2023, 1, 31),), (dt.date(2024, 1, 31),), (dt.date(2023, 2, 28),)], "Date date")
    found = [str(r[0]) for r in series.next_month(dates).collect()]
    assert found == ["2023-02-28", "2024-02-29", "2023-03-28"]
