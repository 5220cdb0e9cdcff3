"""Landed files → bronze: native and salvage readers, lineage, quarantine."""

import datetime as dt
import decimal
import os

from pyspark.sql import functions as F

from layerflow.functions.lineage import file_date
from layerflow.sources import files

SCHEMA = {"type": "struct", "fields": [
    {"name": "id", "type": "int", "nullable": False},
    {"name": "n", "type": "string"},
    {"name": "lat", "type": "decimal"},
]}


def write(dirpath, name, text):
    os.makedirs(dirpath, exist_ok=True)
    with open(os.path.join(dirpath, name), "w") as f:
        f.write(text)


def test_file_date_from_name_and_path(spark):
    df = spark.createDataFrame(
        [("stations_20250115_101010.json", "/x/stations_20250115_101010.json"),
         ("part-0000.txt", "/x/key=a/landed_at=20240301_000000/part-0000.txt"),
         ("stations_2025011_101010.json", "/y/stations_2025011_101010.json"),
         ("s_20251399_000000.json", "/y/s_20251399_000000.json")],
        "name string, path string",
    )
    got = [r[0] for r in df.select(file_date(F.col("name"), F.col("path"))).collect()]
    assert got == [dt.datetime(2025, 1, 15), dt.datetime(2024, 3, 1), None, None]


def test_native_and_salvage_readers(spark, tmp_path):
    d = str(tmp_path / "landing")
    write(d, "a_20250101_000000.json", '[{"id":1,"n":"a","lat":28.4567},{"id":2,"n":"b","lat":"28.455"}]\n')
    write(d, "b_20250102_000000.json", '[{"id":5}, null, {"id":6}]\n')
    write(d, "c_20250103_000000.json", 'null\n')
    write(d, "d_20250104_000000.json", '[{"id":"x","n":"bad"}]\n')

    native = files.read_landed(spark, d, SCHEMA, "json", stream=False, mode="native")
    good = sorted((r.id, r.n, r.lat) for r in files.good_rows(native).collect())
    assert good == [(1, "a", decimal.Decimal("28.46")), (2, "b", decimal.Decimal("28.46"))]
    reasons = sorted(r[files.REASON] for r in files.quarantined_rows(native).collect())
    assert reasons == ["corrupt_record", "corrupt_record", "missing:id"]
    assert native.filter(F.col("file_date") == dt.datetime(2025, 1, 1)).count() == 2

    salvage = files.read_landed(spark, d, SCHEMA, "json", stream=False, mode="salvage")
    good = sorted(r.id for r in files.good_rows(salvage).collect())
    assert good == [1, 2, 5, 6]
    reasons = sorted(r[files.REASON] for r in files.quarantined_rows(salvage).collect())
    assert reasons == ["missing:id", "null_element", "unparsable"]
    bad = files.quarantined_rows(salvage).filter(F.col(files.REASON) == "missing:id").first()
    assert bad.n == "bad"  # wrong-typed field only: the rest of the record stays


def test_pretty_printed_file_needs_whole_file(spark, tmp_path):
    d = str(tmp_path / "pretty")
    write(d, "p_20250101_000000.json", '[\n  {"id": 9,\n   "n": "z"}\n]\n')
    df = files.read_landed(spark, d, SCHEMA, "json", stream=False, mode="salvage", whole_file=True)
    assert [(r.id, r.n) for r in files.good_rows(df).collect()] == [(9, "z")]


def test_stream_ingest_reads_each_file_once(spark, tmp_path):
    d, out, ck = str(tmp_path / "in"), str(tmp_path / "bronze"), str(tmp_path / "ck")
    write(d, "a_20250101_000000.json", '[{"id":1},{"id":2}]\n')
    files.ingest(spark, d, out, ck, SCHEMA, "json", keys=["id"], buckets=4)
    assert spark.read.parquet(out).count() == 2
    files.ingest(spark, d, out, ck, SCHEMA, "json", keys=["id"], buckets=4)
    assert spark.read.parquet(out).count() == 2
    write(d, "b_20250102_000000.json", '[{"id":3}]\n')
    files.ingest(spark, d, out, ck, SCHEMA, "json", keys=["id"], buckets=4)
    got = spark.read.parquet(out)
    assert got.count() == 3 and any(c.startswith("__bucket_") for c in got.columns) and "source_metadata" in got.columns


def test_csv_source_with_declared_schema(spark, tmp_path):
    d = str(tmp_path / "csv")
    write(d, "m_20250101_000000.csv", "1,a,1.234\n2,b,x\n")
    df = files.read_landed(spark, d, SCHEMA, "csv", stream=False)
    got = sorted((r.id, r.n, r.lat) for r in files.good_rows(df).collect())
    assert got[0] == (1, "a", decimal.Decimal("1.23"))
    assert got[1][:2] == (2, "b") and got[1][2] is None
