from pyspark.sql import functions as F

from hayloft.functions.names import make_mojibake, repair_mojibake


def test_repair_cases(spark):
    cases = [("Maïs", "Maïs"), ("MaÃ¯s", "Maïs"), ("abc", "abc"), ("日本", "日本"),
             ("a?b", "a?b"), ("日?", "日?"), (None, None), ("", "")]
    df = spark.createDataFrame([(a,) for a, _ in cases], "n string")
    got = [r.r for r in df.select(repair_mojibake("n").alias("r")).collect()]
    assert got == [b for _, b in cases]


def test_repair_inverts_damage(spark):
    texts = ["Grünfutter", "Maïs silage", "Ration ñ 3", "plain", "Œuvre €"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.r for r in df.select(repair_mojibake(make_mojibake(F.col("t"))).alias("r")).collect()]
    assert got == texts


def test_cases_reach_past_the_fortieth_character(spark, tmp_path):
    import duckdb

    import __spark_entry__ as contract

    rows = [(1, "x" * 40 + " Grünfutter 日 😀"), (2, "y" * 60 + "Maïs"), (3, "short"), (4, ""), (5, None)]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(path)
    got = contract.queries()["name_repair_keeps_texts"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    expected = con.sql(contract.oracle_sql()["name_repair_keeps_texts"]).fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    plain = {r.doc_id: r.name for r in got if r.kind == "plain"}
    assert plain == dict(rows)
    assert {r.name for r in got if r.kind == "damaged" and r.doc_id == 2} == {"y" * 60 + "Maïsï"}
