import pytest

from conftest import d
from hayloft.plans import checks, kpi
from hayloft.plans.contract import ContractError, check_schema, input_names

CONTRACT = "a STRING, b DATE NOT NULL, c LONG"


def test_contract_accepts_matching(spark):
    df = spark.createDataFrame([("x", d("2023-01-01"), 1)], "a string, b date not null, c bigint")
    check_schema(df, CONTRACT)


@pytest.mark.parametrize("ddl", [
    "b date not null, a string, c bigint",   # wrong order
    "a string, b date not null, c int",      # wrong type
    "a string, b date, c bigint",            # nullable where NOT NULL is declared
])
def test_contract_rejects(spark, ddl):
    df = spark.createDataFrame([], ddl)
    with pytest.raises(ContractError):
        check_schema(df, CONTRACT, "t")


def test_input_names_skip_private_and_defaults():
    def fn(load_start, load_done, _helper=None, *, id_mode="hash"):
        return None
    assert input_names(fn) == ["load_start", "load_done"]


def _fact(spark, items):
    return spark.createDataFrame(items, "farm_license string, feed_name string, date date, m double")


def test_row_counts_threshold(spark):
    empty = spark.createDataFrame([], "x int")
    one = spark.createDataFrame([(1,)], "x int")
    two = spark.createDataFrame([(1,), (2,)], "x int")
    got = {r.table: (r.n_rows, r.ok) for r in checks.row_counts({"e": empty, "o": one, "t": two}).collect()}
    assert got == {"e": (0, False), "o": (1, False), "t": (2, True)}


def test_missing_days(spark):
    f = _fact(spark, [("a", "x", d("2023-01-01"), 1.0), ("a", "x", d("2023-01-03"), 1.0),
                      ("b", "y", d("2023-01-02"), 1.0), ("b", "y", d("2023-01-05"), 1.0)])
    assert [str(r.date) for r in checks.missing_days(f).collect()] == ["2023-01-04"]
    per = sorted((r.farm_license, str(r.date)) for r in checks.missing_days(f, keys=["farm_license"]).collect())
    assert per == [("a", "2023-01-02"), ("b", "2023-01-03"), ("b", "2023-01-04")]
    assert checks.missing_days(spark.createDataFrame([], "date date")).count() == 0


def test_bounds_and_entities(spark):
    f = _fact(spark, [("b", "x", d("2023-01-02"), 1.0), ("a", "x", d("2023-01-05"), 1.0), (None, "x", None, 1.0)])
    b = checks.date_bounds(f).collect()[0]
    assert (str(b.min_date), str(b.max_date)) == ("2023-01-02", "2023-01-05")
    assert [r.farm_license for r in checks.entity_list(f).collect()] == ["a", "b"]


def test_kpi_series_filters(spark):
    f = _fact(spark, [
        ("a", "x", d("2023-01-01"), 1.0), ("a", "x", d("2023-01-02"), None),
        ("b", "x", d("2023-01-01"), 2.0), ("b", None, d("2023-01-01"), 5.0),
        ("c", "z", d("2023-01-03"), 3.0),
    ])
    dims = ("farm_license", "feed_name", "date")
    all_rows = kpi.kpi_series(f, dims, "m").collect()
    assert [(r.farm_license, str(r.date), r.m) for r in all_rows] == [
        ("a", "2023-01-01", 1.0), ("a", "2023-01-02", 0.0), ("b", "2023-01-01", 2.0), ("c", "2023-01-03", 3.0)]
    assert [r.farm_license for r in kpi.kpi_series(f, dims, "m", farms="c").collect()] == ["c"]
    assert {r.farm_license for r in kpi.kpi_series(f, dims, "m", farms=["a", "b"]).collect()} == {"a", "b"}
    assert kpi.kpi_series(f, dims, "m", farms=[]).count() == 0
    assert [str(r.date) for r in kpi.kpi_series(f, dims, "m", start="2023-01-02", end="2023-01-02").collect()] \
        == ["2023-01-02"]
    assert kpi.kpi_series(f, dims, None, farms="b").count() == 2
    with pytest.raises(ValueError):
        kpi.kpi_series(f, dims, "nope")


def test_contract_error_names_table_and_columns(spark):
    with pytest.raises(ContractError) as error:
        check_schema(spark.createDataFrame([], "a string, b date not null, c int"), CONTRACT, "fact")
    assert error.value.table == "fact" and "c" in error.value.problems[0]


def test_missing_days_null_keys_and_dates(spark):
    f = _fact(spark, [(None, "x", d("2023-01-01"), 1.0), (None, "x", d("2023-01-04"), 1.0), (None, "x", None, 1.0),
                      ("a", "x", d("2023-01-01"), 1.0), ("a", "x", d("2023-01-02"), 1.0), ("a", "x", d("2023-01-02"), 2.0)])
    got = sorted((r.farm_license, str(r.date)) for r in checks.missing_days(f, keys=["farm_license"]).collect())
    assert got == [(None, "2023-01-02"), (None, "2023-01-03")]


def test_check_gold_fails_a_run(spark):
    whole = _fact(spark, [("a", "x", d("2023-01-01"), 1.0), ("a", "x", d("2023-01-02"), 1.0)])
    gap = _fact(spark, [("a", "x", d("2023-01-01"), 1.0), ("a", "x", d("2023-01-03"), 1.0)])
    checks.check_gold({"t": whole}, {"t": ["farm_license"]})
    with pytest.raises(checks.CheckFailed, match="t lacks 1 days"):
        checks.check_gold({"t": gap}, {"t": ["farm_license"]})
    with pytest.raises(checks.CheckFailed, match="has 0 rows"):
        checks.check_gold({"t": whole.limit(0)}, {"t": []})
