"""Landing preparation (L1-L5) and gold SQL files (Q1, G1)."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from layerflow.operators import nested
from layerflow.plans import gold
from layerflow.sources import landing


def test_resource_key_shapes(spark):
    eps = ["/measures", "/stations", "/stations/{idWeatherstation}/sensors",
           "/readings/summarized/station/{idWeatherstation}/year/{year}"]
    df = spark.createDataFrame([(e,) for e in eps], "e string")
    assert [r[0] for r in df.select(landing.resource_key(F.col("e"))).collect()] == [
        "measures", "stations", "sensors", "readings"]


def test_previous_month_wraps_january(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 15),), (dt.date(2025, 3, 31),)], "d date")
    assert [r[0] for r in df.select(landing.previous_month_param(F.col("d"))).collect()] == ["2024?month=12", "2025?month=2"]


def test_payload_missing_key_is_empty(spark):
    df = spark.createDataFrame([(1, '{"stations": [{"k": 1}, {"k": 2}]}'), (2, '{"other": [{"k": 3}]}'), (3, '{"stations": []}')],
                               "id int, body string")
    got = landing.extract_payload(df, "body", "stations", StructType([StructField("k", LongType())]), ["id"])
    assert sorted((r.id, r.k) for r in got.collect()) == [(1, 1), (1, 2)]


def test_view_statements():
    text = """
    SET x = 1;
    create or refresh materialized view a.b.first AS (
      SELECT 1 AS one
    );
    CREATE OR REFRESH MATERIALIZED VIEW second as (SELECT (2) AS two);
    CREATE OR REFRESH /* why */ MATERIALIZED VIEW third as (
      SELECT max(x) AS m, ');' AS t -- not the end: );
      FROM (SELECT 3 AS x)
    );
    CREATE VIEW ignored AS SELECT 3;
    CREATE OR REFRESH MATERIALIZED VIEW `a;b`.`c` AS (SELECT ");" AS q);
    """
    stmts = gold.view_statements(text)
    assert [n for n, _ in stmts] == ["a.b.first", "second", "third", "`a;b`.`c`"]
    assert stmts[1][1] == "SELECT (2) AS two"
    assert stmts[2][1].startswith("SELECT max(x) AS m, ');' AS t") and stmts[2][1].endswith("FROM (SELECT 3 AS x)")
    assert stmts[3][1] == 'SELECT ");" AS q'
    assert gold.view_statements("nothing here") == []


def test_build_views_in_order(spark):
    text = """CREATE OR REFRESH MATERIALIZED VIEW g.base AS ( SELECT id FROM range(5) );
              CREATE OR REFRESH MATERIALIZED VIEW g.top AS ( SELECT max(id) AS m FROM base );"""
    views = gold.build_views(spark, text)
    assert views["g.top"].first().m == 4


def test_explode_null_and_empty_arrays(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None), (4, [None])], "k int, a array<int>")
    got = sorted(nested.explode_array(df, "a", "x", ["k"]).collect(), key=repr)
    assert [(r.k, r.x) for r in got] == [(1, 1), (1, 2), (4, None)]


def test_daily_readings_filters_validated(spark):
    schema = ("id_weatherstation int, sensors array<struct<id_weatherstationsensor:int, dates:array<struct<"
              "observation_date:date, is_validated:boolean, values:array<struct<mean:double,min:double,max:double,total:double>>>>>>")
    v = [(1.0, 0.0, 2.0, 3.0)]
    rows = [(1, [(10, [(dt.date(2025, 1, 1), True, v), (dt.date(2025, 1, 2), False, v), (dt.date(2025, 1, 3), None, v)]),
                 (11, [])])]
    out = nested.daily_readings(spark.createDataFrame(rows, schema)).collect()
    assert [(r.id_weatherstationsensor, r.observation_date, r.mean) for r in out] == [(10, dt.date(2025, 1, 1), 1.0)]


def test_three_part_names_and_equal_last_parts(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS goldnames")
    spark.range(3).selectExpr("id", "named_struct('b', named_struct('c', id)) as a").write.mode("overwrite").saveAsTable("goldnames.src")
    text = """CREATE OR REFRESH MATERIALIZED VIEW cat.gold.x AS (SELECT t.id, t.a.b.c AS c FROM cat.goldnames.src t WHERE id > 0);
              CREATE OR REFRESH MATERIALIZED VIEW cat.other.x AS (SELECT max(id) AS m FROM cat.gold.x);
              CREATE OR REFRESH MATERIALIZED VIEW y AS (SELECT m FROM other.x JOIN (SELECT 1 AS one) ON true);"""
    views = gold.build_views(spark, text)
    assert sorted(r.c for r in views["cat.gold.x"].collect()) == [1, 2]
    assert views["y"].first().m == 2
    stored = gold.materialize_views(spark, text, str(tmp_path))
    assert len(set(stored.values())) == 3
    assert spark.read.parquet(stored["cat.other.x"]).first().m == 2
    assert spark.read.parquet(stored["cat.gold.x"]).count() == 2
    assert gold.materialize_views(spark, text, str(tmp_path)) == stored  # a refresh takes the place of what was there
    spark.sql("DROP TABLE goldnames.src")


def test_daily_readings_of_other_names(spark):
    rows = spark.sql("SELECT 7 AS plant, array(named_struct('meter', 1, 'days', array(named_struct('d', 5, 'ok', true, 'vs', "
                     "array(named_struct('lo', 2, 'hi', 3), named_struct('lo', 4, 'hi', 9)))))) AS meters")
    out = nested.daily_readings(rows, "plant", "meter", "d", "ok", ("lo", "hi"), ("meters", "days", "vs"))
    assert sorted(map(tuple, out.collect())) == [(7, 1, 5, 2, 3), (7, 1, 5, 4, 9)]
