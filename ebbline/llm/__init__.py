"""Operators of a training-data pipeline: sharding, tokens, dedup, filters, archives, scoring.

One module holds one operator with its own general interface; ``queries`` binds them to the test
tables and ``sql`` states the same results as SQL wherever SQL can.
"""
