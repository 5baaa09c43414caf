"""Article processing and retrieval as Spark DataFrame operators.

Every public operator takes and returns DataFrames, so a job is a chain of
``.transform`` calls that Catalyst sees as one plan.
"""
