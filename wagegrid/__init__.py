"""Job-posting analytics as Spark jobs.

Captured pages become posting tables, postings become clean salaries and
features, and features train and score Spark ML classifiers.  Every operator
takes and returns DataFrames.
"""
