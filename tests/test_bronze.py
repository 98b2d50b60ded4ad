"""Ingest of the feeds: typed scan with refused records, inferred types, snapshots that may be repeated, listings."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import profile
from strata.plans import audit, bronze, silver_financial
from strata.sources import io

SCHEMA = schemas.struct("id STRING, amount DECIMAL(18,2), n INT, b BOOLEAN, at TIMESTAMP, day DATE")
HEADER = "id,amount,n,b,at,day"


def landed(tmp_path, *lines, header=HEADER):
    path = tmp_path / "feed.csv"
    path.write_text("\n".join([header, *lines, ""]))
    return str(path)


def test_refused_records_are_kept_with_their_text(spark, tmp_path):
    good = ['a1,"1,234.50",5,true,2020-01-02 10:00:00,2020-01-02', "a2,,,,,", '" a3 ",-1,+7,FALSE,2020-01-02T10:00:00Z,']
    bad = ["b1,N/A,5,true,2020-01-02 10:00:00,2020-01-02", "b2,1,5.0,true,,", "b3,1,5,maybe,,", "b4,1,5,true,soon,", "b5,1,5,true,,someday",
           "b6,1,5", "b7,1,5,true,,,extra", "b8,1,99999999999,true,,"]
    found = io.read_csv_typed(spark, landed(tmp_path, *good, *bad), SCHEMA, str(tmp_path / "typed"))
    assert found.good.dtypes == [(f.name, f.dataType.simpleString()) for f in SCHEMA.fields]
    assert [tuple(map(str, r)) for r in found.good.orderBy("id").collect()] == [
        (" a3 ", "-1.00", "7", "False", "2020-01-02 10:00:00", "None"), ("a1", "1234.50", "5", "True", "2020-01-02 10:00:00", "2020-01-02"),
        ("a2", "None", "None", "None", "None", "None")]
    assert sorted(r.record for r in found.refused.collect()) == bad
    assert sorted(r.id for r in found.refused.collect()) == [f"b{i}" for i in range(1, 9)]
    # whatever is asked for, no record changes sides
    assert found.good.select("id").count() == 3 and found.refused.select("record").count() == 8
    assert found.refused.where("id = 'b2'").first().amount == 1


def test_typed_scan_of_odd_files(spark, tmp_path):
    none = io.read_csv_typed(spark, landed(tmp_path), SCHEMA, str(tmp_path / "a"))
    assert none.good.count() == 0 == none.refused.count()
    with pytest.raises(Exception, match="(?i)header"):
        io.read_csv_typed(spark, landed(tmp_path, "a,1,1,true,,", header="id,amount,n,b,day,at"), SCHEMA, str(tmp_path / "b"))
    with pytest.raises(ValueError, match="record"):
        io.read_csv_typed(spark, "x", schemas.struct("record STRING"), str(tmp_path / "c"))


def test_ingest_infers_types_and_may_be_repeated(spark, tmp_path):
    io.ensure_schemas(spark, ["bronze"], catalog="spark_catalog")
    path = landed(tmp_path, "a,1.5,1,true,2020-01-02 10:00:00,2020-01-02", "b,2,2,false,,")
    for _ in range(2):
        table = bronze.ingest(spark, path, "bronze.ingest_test", "feed.csv", "2026-01-01 00:00:00", location=str(tmp_path / "t"))
    assert table.count() == 2
    got = [tuple(r) for r in io.describe_table(spark, "bronze.ingest_test").collect()]
    assert got == [("id", "string", 1), ("amount", "double", 2), ("n", "int", 3), ("b", "boolean", 4), ("at", "timestamp", 5), ("day", "date", 6),
                   ("ingestion_timestamp", "timestamp", 7), ("source_file", "string", 8)]
    other = landed(tmp_path, "a,N/A,1,x,,")
    table = bronze.ingest(spark, other, "bronze.ingest_test", "feed.csv", location=str(tmp_path / "t"))
    assert dict(table.dtypes)["amount"] == "string" and table.count() == 1
    typed = bronze.ingest(spark, path, "bronze.ingest_typed", "feed.csv", schema=SCHEMA, location=str(tmp_path / "u"))
    assert dict(typed.dtypes)["n"] == "int"
    text = bronze.ingest(spark, path, "bronze.ingest_text", "feed.csv", infer=False, location=str(tmp_path / "v"))
    assert dict(text.dtypes)["n"] == "string"


def test_unknown_catalog_is_refused(spark):
    with pytest.raises(Exception):
        io.ensure_schemas(spark, ["bronze"], catalog="nowhere")
    assert spark.catalog.currentCatalog() == "spark_catalog"


def test_snapshots_may_be_repeated(spark, tmp_path):
    io.ensure_schemas(spark, ["audit"])
    name, loc = "audit.snapshots_test", str(tmp_path / "m")
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    for as_of, rows in (("2026-01-01", df), ("2026-01-02", df), ("2026-01-02", df), ("2026-01-01", df.limit(1))):
        audit.run(rows, "bronze", "t", "b", as_of=f"{as_of} 00:00:00", append_to=name, append_path=loc)
    audit.run(df, "silver", "t", "b", as_of="2026-01-02 00:00:00", append_to=name, append_path=loc)
    got = sorted((r.layer, r.profiled_at, r.column_name, r.null_count, r.total_rows) for r in spark.table(name).collect())
    one, two = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    assert [g for g in got if g[0] == "bronze" and g[1] == two] == [("bronze", two, "a", 0, 2), ("bronze", two, "b", 1, 2)]
    assert [g[4] for g in got if g[0] == "bronze" and g[1] == one] == [1, 1]  # written again: its own snapshot is replaced
    assert len(got) == 6 and set(spark.table(name).columns) == {f.name for f in schemas.METRICS.fields}
    assert profile.SNAPSHOT_KEYS == ("layer", "table_name", "profiled_at")


def test_list_files_of_nested_folders(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a.csv").write_text("12345")
    (tmp_path / "in" / "sub" / "b b.csv").write_text("1")
    (tmp_path / "in" / "empty.csv").write_text("")
    (tmp_path / "in" / "c.txt").write_text("x")
    got = io.list_files(spark, str(tmp_path / "in") + "/", "*.csv")
    assert {(r.file_name, r["length"]) for r in got.collect()} == {("a.csv", 5), ("sub/b b.csv", 1)}
    assert "content" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.where(F.col("modified").isNull()).count() == 0


def test_stored_layers_follow_their_input(spark, tmp_path, sf_small):
    """A table that is replaced within a session is derived anew."""
    import shutil

    from strata.sources import fixtures as fx

    for t in ("orders", "lineitem", "events", "nation"):
        shutil.copy(f"{sf_small}/{t}.parquet", tmp_path / f"{t}.parquet")
    before = fx.raw_market(spark, str(tmp_path)).count()
    spark.read.parquet(f"{sf_small}/events.parquet").limit(10).toPandas().to_parquet(tmp_path / "events.parquet", coerce_timestamps="us")
    os.utime(tmp_path / "events.parquet")
    assert before > 10 and fx.raw_market(spark, str(tmp_path)).count() == 10


def test_strict_financial_casts(spark, sf_small):
    from strata.sources import fixtures as fx

    raw = fx.raw_financial(spark, sf_small)
    assert silver_financial.build(raw, on_error="fail").count() == silver_financial.build(raw).count()
    broken = raw.withColumn("created_at", F.lit("soon"))
    assert silver_financial.build(broken).where("created_at_bronze is not null").count() == 0
    with pytest.raises(Exception):
        silver_financial.build(broken, on_error="fail").collect()
