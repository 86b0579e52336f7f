import os

import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"


def test_every_catalog_query_has_an_oracle():
    from hayloft.plans.catalog import QUERIES

    qs, sql = contract.queries(), contract.oracle_sql()
    assert set(sql) <= set(qs)
    assert set(QUERIES) <= set(sql)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields][:3] == ["farm_license", "feed_id", "date"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", ["shred_json", "scd2_events", "pair_events_12h", "fill_days_supplier", "split_intervals_week",
                                  "pit_join_two_devices", "farm_fact_full", "kpi_farm_selected", "missing_days",
                                  "missing_days_null_key", "name_repair_keeps_texts", "csv_scan_lineage", "rejected_records",
                                  "rejected_payloads", "table_rewrites", "reconcile_feed_days", "contract_findings", "split_intervals_century",
                                  "pipeline_loading_activity", "pipeline_farm_fact"])
def test_queries_match_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("lineitem", "orders", "events", "documents"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = contract.queries()[name](spark, SF)
    cells = lambda row: tuple(str(row[c]).removesuffix("000") if "." in str(row[c]) else str(row[c]) for c in sorted(row))
    spark_rows = sorted(cells(r.asDict()) for r in got.collect())
    sql = con.sql(contract.oracle_sql()[name])
    sql_rows = sorted(cells(dict(zip(sql.columns, r))) for r in sql.fetchall())
    assert spark_rows and spark_rows == sql_rows
