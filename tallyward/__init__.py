"""Transaction scoring, label reconciliation and warehouse modelling on PySpark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from Spark's own
expressions; ``plans.jobs`` strings them together into the jobs a user runs.
"""
