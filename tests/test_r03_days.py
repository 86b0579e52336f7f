"""How the days of a dense fact are made."""

from conftest import d
from hayloft.operators.intervals import fill_days


def test_days_are_filled_without_the_calendar(spark):
    df = spark.createDataFrame([("a", d("2024-02-27")), ("a", d("2024-03-02")), ("b", None)], "k string, date date")
    out = fill_days(df, ["k"])
    assert [r.date for r in out.orderBy("date").collect()] == [d(f"2024-{x}") for x in ("02-27", "02-28", "02-29", "03-01", "03-02")]
    assert "sequence(0" in out._jdf.queryExecution().optimizedPlan().toString()
