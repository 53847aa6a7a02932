"""File joins and run-history analytics as Spark jobs.

Everything takes and returns DataFrames; the session is always passed in.
"""
