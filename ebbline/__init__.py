"""Customer cash-flow series, struggle labels and next-month predictions on Spark."""

__version__ = "0.1.0"
