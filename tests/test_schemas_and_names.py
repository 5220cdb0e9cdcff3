"""Schemas that change between runs, names in gold bodies, CSV records of a wrong length, silver dealt by size."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerflow import schemas
from layerflow.operators import cdc
from layerflow.plans import gold
from layerflow.sources import files
from layerflow.streaming import cdc_stream


def ddl(text):
    return StructType.fromDDL(text)


@pytest.mark.parametrize("old,new,out", [
    ("a int", "a bigint, b string", "a bigint, b string"), ("a int, c string", "a int", "a int, c string"),
    ("a float", "A double", "a double"), ("a decimal(10,2)", "a decimal(12,3)", "a decimal(12,3)"),
    ("s struct<x: int>", "s struct<y: int, x: bigint>", "s struct<x: bigint, y: int>"),
    ("l array<struct<x: int>>", "l array<struct<x: int, y: string>>", "l array<struct<x: int, y: string>>"),
])
def test_merged(spark, old, new, out):
    assert schemas.merged(ddl(old), ddl(new)) == ddl(out)


@pytest.mark.parametrize("old,new", [
    ("a bigint", "a int"), ("a string", "a int"), ("a decimal(10,2)", "a decimal(10,3)"), ("a array<int>", "a int"), ("s struct<x: string>", "s struct<x: date>")])
def test_refused(spark, old, new):
    with pytest.raises(schemas.SchemaChange):
        schemas.merged(ddl(old), ddl(new))


def test_nested_files_are_read_under_the_newest_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in ("SELECT 1 AS id, array(named_struct('x', 1)) AS l", "SELECT 2L AS id, array(named_struct('x', 2L, 'y', 'b')) AS l, 'n' AS extra"):
        df = spark.sql(rows)
        schemas.fitted(df, schemas.evolve(spark, path, df.schema)).write.mode("append").parquet(path)
    got = sorted((r.id, r.l[0].x, r.l[0].y, r.extra) for r in schemas.read_stored(spark, path).collect())
    assert got == [(1, 1, None, None), (2, 2, "b", "n")]
    before = os.listdir(tmp_path / "t" / "_schema")
    with pytest.raises(schemas.SchemaChange, match="extra"):
        schemas.evolve(spark, path, ddl("extra date"))
    assert os.listdir(tmp_path / "t" / "_schema") == before
    with pytest.raises(schemas.SchemaChange, match="key"):
        schemas.evolve(spark, str(tmp_path / "u"), ddl("k int")) and schemas.evolve(spark, str(tmp_path / "u"), ddl("k bigint"), ("k",))


def test_gold_names(spark):
    spark.sql("SELECT 1 AS id, 10 AS v").createOrReplaceTempView("cte_source")
    text = """
    CREATE OR REFRESH MATERIALIZED VIEW cat.gold.shadow AS (SELECT id, v FROM cte_source);
    CREATE OR REFRESH MATERIALIZED VIEW cat.gold.inner_one AS (WITH shadow AS (SELECT 7 AS id) SELECT * FROM shadow);
    CREATE OR REFRESH MATERIALIZED VIEW cat.gold.two AS (SELECT x.id, y.v FROM cat.gold.shadow x, gold.shadow y WHERE x.id IN (SELECT id FROM cat.gold.shadow));
    CREATE OR REFRESH MATERIALIZED VIEW cat.gold.words AS (
      SELECT EXTRACT(YEAR FROM shadow) AS y, shadow IS DISTINCT FROM shadow AS d, trim(BOTH 'x' FROM 'xax') AS t
      FROM (SELECT DATE'2024-05-01' AS shadow) s);
    CREATE OR REFRESH MATERIALIZED VIEW cat.gold.nested AS (
      WITH a AS (WITH shadow AS (SELECT 5 AS id) SELECT id FROM shadow), b AS (SELECT id FROM shadow) SELECT a.id AS a, b.id AS b FROM a, b);
    """
    views = gold.build_views(spark, text)
    rows = {name.split(".")[-1]: [tuple(r) for r in df.collect()] for name, df in views.items()}
    assert rows["inner_one"] == [(7,)] and rows["two"] == [(1, 10)] and rows["words"] == [(2024, False, "a")] and rows["nested"] == [(5, 1)]


def test_csv_records_of_a_wrong_length(spark, tmp_path):
    schema = ddl("a int, b string, c string")

    def reasons(lines, **options):
        path = tmp_path / str(len(os.listdir(tmp_path)))
        path.mkdir()
        (path / "f.csv").write_text("\n".join(lines) + "\n")
        read = files.read_landed(spark, str(path), schema, "csv", stream=False, options=options)
        return {r[files.CORRUPT] or "": r[files.REASON] for r in read.collect()}

    got = reasons(["1,x,y", '2,"p,q"', "3,x", "4,x,y,EXTRA", '5,"a,b",c', '6,"say ""hi, you""",z', "bad,x,y", "7,,", "8,x,", '9,x,y,"e,f",g', "10"], escape='"')
    assert {k: v for k, v in got.items() if v} == {
        '2,"p,q"': "short_row", "3,x": "short_row", "4,x,y,EXTRA": "long_row", '9,x,y,"e,f",g': "long_row", "10": "short_row"}
    got = reasons(["1||x||y", "2||x", "3||x||y||z", '4||"p||q"||r'], sep="||")
    assert {k: v for k, v in got.items() if v} == {"2||x": "short_row", "3||x||y||z": "long_row"}


def test_few_buckets_fill_all_partitions_and_make_bounded_files(spark, tmp_path):
    """Eight buckets, 32 shuffle partitions, one key with a third of all rows: the stage has more tasks than buckets, a
    bucket's era has several files, and the rows are those of the plain plan."""
    feed = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 400).alias("k"), F.col("id").alias("seq"), (F.col("id") % 7).alias("v"))
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    feed.write.parquet(bronze)
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cdc_stream.apply_changes(spark, bronze, silver, str(tmp_path / "ck"), ["k"], "seq", buckets=8, track=["v"], file_bytes=8 << 10)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    staged = [f for d, _, fs in os.walk(tmp_path / "ck" / "stage") for f in fs if f.startswith("part-") and "rows" in d]
    assert len(staged) > 16
    per_folder = [sum(f.startswith("part-") for f in fs) for _, _, fs in os.walk(silver) if any(f.startswith("part-") for f in fs)]
    assert max(per_folder) > 2
    want = cdc.scd2_from_changes(feed, ["k"], "seq", track=["v"])
    canon = lambda df: sorted(map(tuple, df.select("k", "seq", "v", cdc.START_AT, cdc.END_AT).collect()), key=str)
    assert canon(cdc_stream.read_silver(spark, silver)) == canon(want)
