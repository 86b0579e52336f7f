"""hayloft — layered (bronze → silver → gold) telemetry processing on Spark.

Every operator is a function ``DataFrame(s) -> DataFrame`` built only from
Spark's DataFrame API, so Catalyst plans, prunes and pushes down the work.
No operator triggers an action; only the runner (``plans.contract``), the
sinks and the checks do.
"""

__version__ = "0.1.0"
