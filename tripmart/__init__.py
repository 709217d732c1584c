"""Trip analytics on Spark: zones, cleaning, a star schema, rollups and reports.

Every transformation is a plain function from DataFrames to a DataFrame; only
``tripmart.sinks`` and ``tripmart.plans.monthly`` run actions.
"""
