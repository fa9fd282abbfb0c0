"""Flows: data sets, training and scoring."""
