"""Table layouts.

Amounts are decimals: a running balance that lands on exactly zero must compare as zero, whatever
order the partial sums arrive in.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# The columns of the transaction table, in its order.
TRANSACTIONS = _struct(
    ("CustomerID", T.StringType()),
    ("ProductCode", T.StringType()),
    ("TransAmount", MONEY),
    ("TransDate", T.TimestampNTZType()),
    ("TransType", T.StringType()),
)

DAILY_FLOWS = _struct(
    ("CustomerID", T.StringType()),
    ("ProductCode", T.StringType()),
    ("Day", T.DateType()),
    ("CreditSum", T.DecimalType(28, 2)),
    ("DebitSum", T.DecimalType(28, 2)),
    ("CreditCount", T.LongType()),
    ("DebitCount", T.LongType()),
)

# The column names of the customer feature table, in its order.
FEATURE_COLUMNS = [
    "CustomerID",
    "Age",
    "Week_1_Avg_Credit",
    "Week_2_Avg_Credit",
    "Week_3_Avg_Credit",
    "Week_4_Avg_Credit",
    "Week_1_Avg_Debit",
    "Week_2_Avg_Debit",
    "Week_3_Avg_Debit",
    "Week_4_Avg_Debit",
    "Weekly_Min_Credit",
    "Weekly_Min_Debit",
    "Weekly_Max_Credit",
    "Weekly_Max_Debit",
    "Weekly_Median_Credit",
    "Weekly_Median_Debit",
    "Weekly_Count_Median_Credit",
    "Weekly_Count_Median_Debit",
    "Weekly_Count_Variance_Credit",
    "Weekly_Count_Variance_Debit",
    "Monthly_Min_Credit",
    "Monthly_Min_Debit",
    "Monthly_Max_Credit",
    "Monthly_Max_Debit",
    "Monthly_Median_Credit",
    "Monthly_Median_Debit",
    "Monthly_Count_Median_Credit",
    "Monthly_Count_Median_Debit",
    "Monthly_Count_Variance_Credit",
    "Monthly_Count_Variance_Debit",
    "Last_Month_PCT_CH_Credit",
    "Last_Month_PCT_CH_Debit",
    "SegmentID",
]

CUSTOMER_FEATURES = T.StructType(
    [T.StructField("CustomerID", T.StringType(), True)]
    + [T.StructField(name, T.DoubleType(), True) for name in FEATURE_COLUMNS[1:-1]]
    + [T.StructField("SegmentID", T.IntegerType(), True)]
)

# The model's input vector, in its order.
MODEL_FEATURES = [
    "SegmentID",
    "Credit",
    "Debit",
    "Balance",
    "Prev_Mean_Bal",
    "Age",
    "Week_1_Avg_Credit",
    "Week_2_Avg_Credit",
    "Week_3_Avg_Credit",
    "Week_4_Avg_Credit",
    "Week_1_Avg_Debit",
    "Week_2_Avg_Debit",
    "Week_3_Avg_Debit",
    "Week_4_Avg_Debit",
    "Monthly_Count_Median_Credit",
    "Monthly_Count_Median_Debit",
    "Monthly_Count_Variance_Credit",
    "Monthly_Count_Variance_Debit",
]

IDENTIFIERS = ["CustomerID", "ProductCode", "Date"]
TARGET = "Struggle_shifted"

# The columns of the budget, prediction and log tables, in their order.
BUDGETS = _struct(
    ("BudgetID", T.StringType()),
    ("CustomerID", T.StringType()),
    ("CategoryTypeCode", T.StringType()),
    ("AllocatedAmount", T.DoubleType()),
)

BUDGET_TRANSACTIONS = _struct(
    ("BudgetID", T.StringType()),
    ("TransAmount", T.DoubleType()),
    ("TransDate", T.TimestampNTZType()),
    ("CalendarYearMonth", T.StringType()),
    ("AllocatedAmount", T.DoubleType()),
)

CATEGORY_TYPES = _struct(
    ("CategoryTypeCode", T.StringType()),
    ("CategoryTypeName", T.StringType()),
)

WEEKLY_BUDGET = _struct(
    ("CustomerID", T.StringType()),
    ("Week", T.DateType()),
    ("AllocatedAmount", T.DoubleType()),
    ("CategoryTypeCode", T.StringType()),
    ("Spending", T.DoubleType()),
)

OVERRIDE_RULES = _struct(
    ("CustomerID", T.StringType()),
    ("Struggle", T.IntegerType()),
    ("StruggleWeek", T.IntegerType()),
    ("FundingAmount", T.IntegerType()),
)

PREDICTIONS_SINK = _struct(
    ("CustomerID", T.StringType()),
    ("Date", T.DateType()),
    ("Struggle", T.IntegerType()),
)

TRAINING_LOG = _struct(
    ("ModelName", T.StringType()),
    ("TrainingDate", T.DateType()),
    ("ModelScore", T.DoubleType()),
)
