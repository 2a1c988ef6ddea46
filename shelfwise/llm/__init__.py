"""Operators of a training-data pipeline, as Spark jobs.

One module per operator; ``queries`` registers the thin ``opN_*`` queries and
``oracles`` their SQL.  Nothing outside this package imports it.
"""
