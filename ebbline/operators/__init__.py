"""Relational and time-series operators over transactions, series and predictions."""
