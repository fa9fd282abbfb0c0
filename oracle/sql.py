"""The registered queries in plain SQL, written from the semantics rather than from the Spark code.

Sums are taken on exact decimals and cast to DOUBLE at the end; eligibility is stated as a grouped
subquery where Spark uses windows.
"""

from __future__ import annotations

from ebbline.schemas import FEATURE_COLUMNS, MODEL_FEATURES

TX = """
tx AS (
  SELECT CAST(o_custkey AS VARCHAR) AS CustomerID, l_linestatus AS ProductCode,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS TransAmount, o_orderdate AS TransDate,
         CASE WHEN l_returnflag = 'R' THEN 'D' ELSE 'C' END AS TransType
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

MONTHLY = TX + """,
monthly AS (
  SELECT CustomerID, ProductCode, CAST(last_day(TransDate) AS DATE) AS Date,
         coalesce(sum(TransAmount) FILTER (TransType = 'C'), 0) AS Credit,
         coalesce(sum(TransAmount) FILTER (TransType = 'D'), 0) AS Debit
  FROM tx GROUP BY 1, 2, 3
)"""

BALANCE = MONTHLY + """,
balance AS (
  SELECT *, sum(Credit - Debit) OVER (PARTITION BY CustomerID ORDER BY ProductCode, Date
                                      ROWS UNBOUNDED PRECEDING) AS Balance
  FROM monthly
)"""

ELIGIBLE = BALANCE + """,
positive AS (
  SELECT CustomerID, ProductCode,
         CAST(sum(CASE WHEN Balance < 0 THEN 0 ELSE 1 END) AS BIGINT) AS PositiveMonths
  FROM balance GROUP BY 1, 2
),
eligible AS (
  SELECT * FROM balance WHERE CustomerID IN (SELECT CustomerID FROM positive WHERE PositiveMonths = 8)
)"""

LABELLED = ELIGIBLE + """,
means AS (
  SELECT *, CASE WHEN count(*) OVER w = 3 THEN CAST(sum(Balance) OVER w AS DOUBLE) / 3 END AS P
  FROM eligible
  WINDOW w AS (PARTITION BY CustomerID, ProductCode ORDER BY Date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)
),
flagged AS (
  SELECT * EXCLUDE (P), coalesce(P, 0) AS Prev_Mean_Bal,
         CASE WHEN CAST(Balance AS DOUBLE) < P - CAST(0.3 AS DOUBLE) * P THEN 1 ELSE 0 END AS Struggle
  FROM means
),
labelled AS (
  SELECT *, coalesce(lead(Struggle) OVER (PARTITION BY CustomerID ORDER BY ProductCode, Date), 0)
            AS Struggle_shifted
  FROM flagged
),
latest AS (
  SELECT CustomerID, ProductCode, CAST(Date + INTERVAL 1 MONTH AS DATE) AS Date,
         Credit, Debit, Balance, Prev_Mean_Bal, Struggle
  FROM flagged
  QUALIFY row_number() OVER (PARTITION BY CustomerID, ProductCode ORDER BY Date DESC) = 1
)"""


def _period(grain: str, name: str) -> str:
    start = f"CAST(date_trunc('{grain}', TransDate) AS DATE)"
    return f"""
{name}_rows AS (
  SELECT CustomerID, {start} AS s,
         CAST(coalesce(sum(TransAmount) FILTER (TransType = 'C'), 0) AS DOUBLE) AS Credit,
         CAST(coalesce(sum(TransAmount) FILTER (TransType = 'D'), 0) AS DOUBLE) AS Debit,
         count(*) FILTER (TransType = 'C') AS nCredit, count(*) FILTER (TransType = 'D') AS nDebit
  FROM tx GROUP BY 1, 2
)"""


def _stats(grain: str, name: str) -> str:
    cells = []
    for side in ("Credit", "Debit"):
        cells += [
            f"min({side}) AS {grain}_Min_{side}",
            f"max({side}) AS {grain}_Max_{side}",
            f"quantile_cont({side}, 0.5) AS {grain}_Median_{side}",
            f"quantile_cont(CAST(n{side} AS DOUBLE), 0.5) AS {grain}_Count_Median_{side}",
            f"var_samp(CAST(n{side} AS DOUBLE)) AS {grain}_Count_Variance_{side}",
        ]
    return f"{name}_stats AS (SELECT CustomerID, {', '.join(cells)} FROM {name}_rows GROUP BY 1)"


def _week_slots() -> str:
    cells = []
    for side, kind in (("Credit", "C"), ("Debit", "D")):
        for k in range(1, 5):
            here = f"(TransType = '{kind}' AND least(4, (day(TransDate) - 1) // 7 + 1) = {k})"
            cells.append(
                f"CAST(sum(TransAmount) FILTER {here} AS DOUBLE) / count(*) FILTER {here}"
                f" AS Week_{k}_Avg_{side}"
            )
    return f"slots AS (SELECT CustomerID, {', '.join(cells)} FROM tx GROUP BY 1)"


def _features() -> str:
    change = [
        f"max(CASE WHEN rn = 1 AND p{s} <> 0 THEN ({s} - p{s}) / p{s} END) AS Last_Month_PCT_CH_{s}"
        for s in ("Credit", "Debit")
    ]
    columns = []
    for name in FEATURE_COLUMNS:
        if name in ("CustomerID", "SegmentID"):
            columns.append(name)
        elif name == "Age":
            columns.append("Age")
        else:
            columns.append(f"round(coalesce({name}, 0), 6) AS {name}")
    return f"""
{_period('week', 'week')},{_period('month', 'month')},
{_stats('Weekly', 'week')},
{_stats('Monthly', 'month')},
{_week_slots()},
steps AS (
  SELECT CustomerID, Credit, Debit,
         lag(Credit) OVER (PARTITION BY CustomerID ORDER BY s) AS pCredit,
         lag(Debit) OVER (PARTITION BY CustomerID ORDER BY s) AS pDebit,
         row_number() OVER (PARTITION BY CustomerID ORDER BY s DESC) AS rn
  FROM month_rows
),
change AS (SELECT CustomerID, {', '.join(change)} FROM steps GROUP BY 1),
profile AS (
  SELECT CAST(c_custkey AS VARCHAR) AS CustomerID, CAST(18 + c_custkey % 60 AS DOUBLE) AS Age,
         CAST(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
              WHEN 'HOUSEHOLD' THEN 4 WHEN 'MACHINERY' THEN 5 END AS INTEGER) AS SegmentID,
         c_mktsegment
  FROM customer
),
features AS (
  SELECT {', '.join(columns)}
  FROM profile LEFT JOIN week_stats USING (CustomerID) LEFT JOIN month_stats USING (CustomerID)
       LEFT JOIN slots USING (CustomerID) LEFT JOIN change USING (CustomerID)
)"""


def _sentinels() -> str:
    names = [n for n in FEATURE_COLUMNS if n not in ("CustomerID", "Age", "SegmentID")]
    return ", ".join(f"round(coalesce({n}, -1), 6) AS {n}" for n in names)


FEATURES = TX + "," + _features()
TRAINING = LABELLED + "," + _features()

_DATE = "CAST(Date AS VARCHAR) AS Date"
_IDS = f"CustomerID, ProductCode, {_DATE}"
_FEATURE_LIST = ", ".join(FEATURE_COLUMNS[1:])
_AMOUNTS = "CAST(Credit AS DOUBLE) AS Credit, CAST(Debit AS DOUBLE) AS Debit, CAST(Balance AS DOUBLE) AS Balance"
_MACHINERY = "(SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'MACHINERY')"

TRAIN_ROWS = TRAINING + f""",
train AS (
  SELECT CustomerID, ProductCode, Date, {_AMOUNTS}, Prev_Mean_Bal, Struggle, Struggle_shifted, {_FEATURE_LIST}
  FROM labelled JOIN features USING (CustomerID)
)"""


def _scaler_rows() -> str:
    rows = [
        f"SELECT '{f}' AS feature, quantile_cont(CAST({f} AS DOUBLE), 0.5) AS median,"
        f" quantile_cont(CAST({f} AS DOUBLE), 0.75) - quantile_cont(CAST({f} AS DOUBLE), 0.25) AS iqr FROM train"
        for f in MODEL_FEATURES
    ]
    return "scaler AS (" + " UNION ALL ".join(rows) + ")"


def _scaled() -> str:
    cells = []
    for f in MODEL_FEATURES:
        median = f"(SELECT round(median, 6) FROM scaler WHERE feature = '{f}')"
        iqr = f"(SELECT CASE WHEN iqr < 1e-14 THEN 1 ELSE round(iqr, 6) END FROM scaler WHERE feature = '{f}')"
        cells.append(f"round((CAST({f} AS DOUBLE) - {median}) / {iqr}, 6) AS {f}")
    return ", ".join(cells)


_KEY = "concat_ws('|', '{}', CustomerID, ProductCode, CAST(Date AS VARCHAR))"


def _bucket(buckets: int, salt: str) -> str:
    return f"CAST(('0x' || substr(md5({_KEY.format(salt)}), 1, 8)) AS BIGINT) % {buckets}"


_RULED = """
ruled AS (
  SELECT CustomerID, ProductCode, Date,
         CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE Struggle END AS INTEGER) AS Struggle,
         CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 3 ELSE 0 END AS INTEGER) AS StruggleWeek,
         CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 152 ELSE 0 END AS INTEGER) AS FundingAmount
  FROM latest LEFT JOIN customer ON CustomerID = CAST(c_custkey AS VARCHAR)
)"""

_WEEKLY_BUDGET = TX + """,
spent AS (
  SELECT CustomerID, CAST(date_trunc('week', TransDate) AS DATE) AS Week, sum(TransAmount) AS Spending
  FROM tx WHERE TransType = 'D' GROUP BY 1, 2
)
SELECT CustomerID, CAST(Week AS VARCHAR) AS Week,
       coalesce(CAST(sum(Spending) OVER w AS DOUBLE) / nullif(count(*) OVER w, 0), 0) AS AllocatedAmount,
       c_mktsegment AS CategoryTypeCode, CAST(Spending AS DOUBLE) AS Spending
FROM spent JOIN customer ON CustomerID = CAST(c_custkey AS VARCHAR)
WINDOW w AS (PARTITION BY CustomerID ORDER BY Week ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"""

_LABELLED_SERIES = f"""WITH {LABELLED}
SELECT {_IDS}, {_AMOUNTS}, Prev_Mean_Bal, Struggle, Struggle_shifted FROM labelled"""

_TX_COLUMNS = "CustomerID, ProductCode, CAST(TransAmount AS DOUBLE) AS TransAmount, TransDate, TransType"
_WINDOW = """o_orderdate BETWEEN (SELECT max(o_orderdate) FROM orders) - INTERVAL 3 MONTH
                     AND (SELECT max(o_orderdate) FROM orders)"""

_SCALER_STATS = f"""WITH {TRAIN_ROWS}, {_scaler_rows()}
SELECT feature, round(median, 6) AS median, round(iqr, 6) AS iqr FROM scaler"""

_SCALED_FEATURES = f"""WITH {TRAIN_ROWS}, {_scaler_rows()}
SELECT {_IDS}, {_scaled()}, Struggle_shifted FROM train"""

_RULE_METRICS = f"""WITH {LABELLED},
test AS (SELECT * FROM labelled WHERE {_bucket(100, '42')} < 20),
n AS (
  SELECT count(*) FILTER (Struggle = 1 AND Struggle_shifted = 1) AS tp,
         count(*) FILTER (Struggle = 1 AND Struggle_shifted = 0) AS fp,
         count(*) FILTER (Struggle = 0 AND Struggle_shifted = 1) AS fn,
         count(*) FILTER (Struggle = 0 AND Struggle_shifted = 0) AS tn
  FROM test
)
SELECT *, CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) * 100 AS accuracy,
       CASE WHEN 2 * tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE 0 END AS f1
FROM n"""

STATEMENTS = {
    "transactions_scan": f"WITH {TX} SELECT {_TX_COLUMNS} FROM tx",
    "transactions_for_customers": f"WITH {TX} SELECT {_TX_COLUMNS} FROM tx WHERE CustomerID IN {_MACHINERY}",
    "trailing_three_months": f"""
SELECT CAST(o_custkey AS VARCHAR) AS BudgetID, o_totalprice AS TransAmount, o_orderdate AS TransDate,
       strftime(o_orderdate, '%Y%m') AS CalendarYearMonth, c_acctbal AS AllocatedAmount
FROM orders JOIN customer ON o_custkey = c_custkey WHERE {_WINDOW}""",
    "budgets_active_in_window": f"""
SELECT CAST(c_custkey AS VARCHAR) AS BudgetID, CAST(c_custkey AS VARCHAR) AS CustomerID,
       c_mktsegment AS CategoryTypeCode, c_acctbal AS AllocatedAmount
FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE {_WINDOW})""",
    "category_dimension": """
SELECT DISTINCT c_mktsegment AS CategoryTypeCode,
       upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS CategoryTypeName
FROM customer""",
    "daily_flows": f"""WITH {TX}
SELECT CustomerID, ProductCode, CAST(CAST(TransDate AS DATE) AS VARCHAR) AS Day,
       CAST(sum(TransAmount) FILTER (TransType = 'C') AS DOUBLE) AS CreditSum,
       CAST(sum(TransAmount) FILTER (TransType = 'D') AS DOUBLE) AS DebitSum,
       count(*) FILTER (TransType = 'C') AS CreditCount, count(*) FILTER (TransType = 'D') AS DebitCount
FROM tx GROUP BY 1, 2, 3""",
    "monthly_flows": f"""WITH {MONTHLY}
SELECT CustomerID, ProductCode, CAST(year(Date) AS INTEGER) AS year, CAST(month(Date) AS INTEGER) AS Month,
       CAST(Credit AS DOUBLE) AS Credit, CAST(Debit AS DOUBLE) AS Debit,
       CAST(Credit - Debit AS DOUBLE) AS NetFlow
FROM monthly""",
    "unexpected_types_quarantine": f"""
SELECT CAST(o_custkey AS VARCHAR) AS CustomerID, l_linestatus AS ProductCode,
       l_extendedprice AS TransAmount, o_orderdate AS TransDate, l_returnflag AS TransType
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag NOT IN ('A', 'R')""",
    "monthly_balance": f"WITH {BALANCE} SELECT {_IDS}, {_AMOUNTS} FROM balance",
    "positive_month_counts": f"WITH {ELIGIBLE} SELECT *, PositiveMonths = 8 AS Qualifies FROM positive",
    "eligible_series": f"WITH {ELIGIBLE} SELECT {_IDS}, {_AMOUNTS} FROM eligible",
    "prev_mean_balance": f"""WITH {LABELLED}
SELECT {_IDS}, {_AMOUNTS}, Prev_Mean_Bal FROM flagged""",
    "labelled_series": _LABELLED_SERIES,
    "labelled_series_in_blocks": _LABELLED_SERIES,
    "latest_per_series": f"""WITH {LABELLED}
SELECT {_IDS}, {_AMOUNTS}, Prev_Mean_Bal FROM latest""",
    "customer_features": f"WITH {FEATURES} SELECT * FROM features",
    "features_for_customers": f"WITH {FEATURES} SELECT * FROM features WHERE CustomerID IN {_MACHINERY}",
    "feature_table_scan": f"WITH {FEATURES} SELECT * FROM features",
    "sentinel_filled_features": f"""WITH {FEATURES}
SELECT CustomerID, {_sentinels()}
FROM (SELECT DISTINCT CustomerID FROM tx) LEFT JOIN week_stats USING (CustomerID)
     LEFT JOIN month_stats USING (CustomerID) LEFT JOIN slots USING (CustomerID)
     LEFT JOIN change USING (CustomerID)""",
    "training_set": f"WITH {TRAIN_ROWS} SELECT * REPLACE ({_DATE}) FROM train",
    "inference_set": f"""WITH {TRAINING}
SELECT {_IDS}, {_AMOUNTS}, Prev_Mean_Bal, {_FEATURE_LIST}
FROM latest JOIN features USING (CustomerID)""",
    "inference_set_for_customers": f"""WITH {TRAINING}
SELECT {_IDS}, {_AMOUNTS}, Prev_Mean_Bal, {_FEATURE_LIST}
FROM latest JOIN features USING (CustomerID) WHERE CustomerID IN {_MACHINERY}""",
    "scaler_stats": _SCALER_STATS,
    "scaler_roundtrip": _SCALER_STATS,
    "scaled_features": _SCALED_FEATURES,
    "model_vectors": _SCALED_FEATURES,
    "stratified_split_counts": f"""WITH {LABELLED}
SELECT CASE WHEN {_bucket(100, '42')} < 20 THEN 'test' ELSE 'train' END AS split,
       Struggle_shifted, count(*) AS rows
FROM labelled GROUP BY 1, 2""",
    "stratified_split": f"""WITH {LABELLED},
sizes AS (SELECT Struggle_shifted AS y, count(*) AS n FROM labelled GROUP BY 1),
total AS (SELECT sum(n) AS n, sum(n) - CAST(ceil(sum(n) * 20 / CAST(100 AS DOUBLE)) AS BIGINT) AS train FROM sizes),
shares AS (
  SELECT y, sizes.n, sizes.n * train // total.n AS whole, sizes.n * train % total.n AS part, train
  FROM sizes, total
),
quota AS (
  SELECT y, n, whole + CASE WHEN row_number() OVER (ORDER BY part DESC, y) <= train - sum(whole) OVER ()
                            THEN 1 ELSE 0 END AS keep
  FROM shares
),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY Struggle_shifted ORDER BY md5({_KEY.format('42')})) AS place
  FROM labelled
)
SELECT {_IDS}, Struggle_shifted,
       CASE WHEN place <= n - keep THEN 'test' ELSE 'train' END AS split
FROM ordered JOIN quota ON y = Struggle_shifted""",
    "hashed_fold_counts": f"""WITH {LABELLED}
SELECT CAST({_bucket(5, '42-fold')} AS INTEGER) AS fold, Struggle_shifted, count(*) AS rows
FROM labelled GROUP BY 1, 2""",
    "confusion_counts": f"""WITH {LABELLED}
SELECT Struggle_shifted AS label, Struggle AS prediction, count(*) AS rows FROM labelled GROUP BY 1, 2""",
    "rule_scorer_metrics": _RULE_METRICS,
    "training_log_roundtrip": f"""
SELECT 'rule' AS ModelName, '2023-01-21' AS TrainingDate, accuracy AS ModelScore FROM ({_RULE_METRICS})""",
    "rule_scorer_auc": f"""WITH {LABELLED},
ranked AS (
  SELECT Struggle_shifted AS y,
         rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / CAST(2 AS DOUBLE) AS r
  FROM (SELECT *, Prev_Mean_Bal - CAST(Balance AS DOUBLE) AS s FROM labelled)
),
n AS (SELECT count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS q, sum(r) FILTER (y = 1) AS r FROM ranked)
SELECT round((r - p * (p + 1) / CAST(2 AS DOUBLE)) / (CAST(p AS DOUBLE) * q), 9) AS auc FROM n""",
    "predictions_with_overrides": f"WITH {LABELLED}, {_RULED} SELECT * REPLACE ({_DATE}) FROM ruled",
    "prediction_records": f"""WITH {LABELLED}, {_RULED}
SELECT CustomerID, epoch_ms(CAST(Date AS TIMESTAMP)) AS Date, Struggle, StruggleWeek, FundingAmount FROM ruled""",
    "predictions_sink_roundtrip": f"WITH {LABELLED}, {_RULED} SELECT CustomerID, {_DATE}, Struggle FROM ruled",
    "weekly_budget": f"WITH {_WEEKLY_BUDGET}",
    "weekly_budget_reload": f"WITH {_WEEKLY_BUDGET}",
}

# Rows of a label take the numbers after those of the labels before; a row's fold is its place's turn.
STATEMENTS["stratified_folds"] = f"""WITH parted AS ({STATEMENTS["stratified_split"]}),
train AS (SELECT *, row_number() OVER (PARTITION BY Struggle_shifted ORDER BY md5({_KEY.format('42-fold')})) AS place
          FROM parted WHERE split = 'train'),
sizes AS (SELECT Struggle_shifted AS y, count(*) AS n FROM train GROUP BY 1),
starts AS (SELECT y, n, sum(n) OVER (ORDER BY y) - n AS start FROM sizes),
folds AS (
  SELECT y, fold, sum(of_fold) OVER (PARTITION BY y ORDER BY fold) AS last FROM (
    SELECT y, fold, (start + n - fold + 4) // 5 - (start - fold + 4) // 5 AS of_fold FROM starts, range(5) AS f(fold))
)
SELECT {_IDS}, Struggle_shifted, CAST(min(fold) AS INTEGER) AS fold
FROM train JOIN folds ON y = Struggle_shifted AND place <= last GROUP BY ALL"""
STATEMENTS["fold_counts"] = f"""
SELECT fold, Struggle_shifted, count(*) AS rows FROM ({STATEMENTS["stratified_folds"]}) GROUP BY 1, 2"""

# Tables that are stored and scanned hold what they were made from.
STATEMENTS |= {
    "stored_transactions_for_customers": STATEMENTS["transactions_for_customers"],
    "stored_features_for_customers": STATEMENTS["features_for_customers"],
    "bucketed_labelled_series": STATEMENTS["labelled_series"],
    "bucketed_flows_for_customers": f"SELECT * FROM ({STATEMENTS['daily_flows']}) WHERE CustomerID IN {_MACHINERY}",
    "stored_flows_of_trailing_months": f"""WITH flows AS ({STATEMENTS['daily_flows']})
SELECT * FROM flows WHERE CAST(Day AS DATE) >= (SELECT CAST(max(CAST(Day AS DATE)) - INTERVAL 3 MONTH AS DATE) FROM flows)""",
    "stored_trailing_months": STATEMENTS["trailing_three_months"],
    "stored_budgets_in_window": STATEMENTS["budgets_active_in_window"],
    "training_set_in_blocks": STATEMENTS["training_set"],
    "stored_categories": STATEMENTS["category_dimension"],
    "detected_types_monthly_flows": STATEMENTS["monthly_flows"],
}

# What a trained model predicts has no SQL. Its rows, keys, rule columns and test shares have; and so has a
# target that can be learned exactly. The one override rule in use is for customer 9813.
_TO_SCORE = f"""WITH {TRAINING},
scored AS (
  SELECT CustomerID, ProductCode, latest.Date AS Date, CASE CustomerID WHEN '9813' THEN 3 ELSE 0 END AS StruggleWeek,
         CASE CustomerID WHEN '9813' THEN 152 ELSE 0 END AS FundingAmount
  FROM latest JOIN features USING (CustomerID)
)"""

STATEMENTS |= {
    "segment_predictions": f"WITH {TRAIN_ROWS} SELECT {_IDS}, CAST(SegmentID > 3 AS INTEGER) AS predicted FROM train",
    "segment_predictions_by_drawn_columns": f"WITH {TRAIN_ROWS} SELECT {_IDS}, CAST(SegmentID > 3 AS INTEGER) AS predicted FROM train",
    "segment_grid_auc": "SELECT depth::INTEGER AS max_depth, 1.0::DOUBLE AS mean_auc FROM (VALUES (4), (5)) AS d(depth)",
    "stored_model_agrees": f"{_TO_SCORE} SELECT {_IDS}, TRUE AS agrees FROM scored",
    "model_predictions": f"{_TO_SCORE} SELECT {_IDS}, StruggleWeek, FundingAmount, TRUE AS is_label FROM scored",
    "scored_sink": f"{_TO_SCORE} SELECT CustomerID, {_DATE}, TRUE AS is_label FROM scored",
    "score_customers": f"""{_TO_SCORE}
SELECT '{{"CustomerID":"' || CustomerID || '","Date":' || epoch_ms(CAST(Date AS TIMESTAMP)) || ',"Struggle":#,"StruggleWeek":'
       || StruggleWeek || ',"FundingAmount":' || FundingAmount || '}}' AS record
FROM scored WHERE CustomerID IN {_MACHINERY}""",
    "model_metrics": f"""
SELECT count(*) FILTER (Struggle_shifted = 1) AS struggling, count(*) FILTER (Struggle_shifted = 0) AS calm,
       TRUE AS accuracy_is_percent
FROM ({STATEMENTS["stratified_split"]}) WHERE split = 'test'""",
    "grid_search_auc": "SELECT depth::INTEGER AS max_depth, TRUE AS better_than_chance FROM (VALUES (4), (5)) AS d(depth)",
}
