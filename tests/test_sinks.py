"""Checked sinks: round trips, order over files, and what they refuse."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pickwise.sources import sinks

ODD = [("a", None, 1, 0.1), ("", 'x\n"q" ,', None, -0.0), (" b ", "\\", 3, 1e300), (None, "", 4, None), ("ü", "\t", 5, 2.5), ("a", None, 1, 0.1)]
SCHEMA = "k string, v string, n int, d double"


@pytest.mark.parametrize("fmt", ["csv", "parquet", "orc"])
def test_odd_values_come_back(spark, tmp_path, fmt):
    df = spark.createDataFrame(ODD, SCHEMA)
    r = sinks.write_checked(df, str(tmp_path / "x"), fmt, order_by=["k", "n"])
    assert r.good and (r.rows_written, r.rows_read) == (6, 6)
    assert rows(sinks.read_dataset(df, r.path, fmt)) == rows(df)


def test_blanks_for_nulls(spark, tmp_path):
    df = spark.createDataFrame(ODD, SCHEMA)
    sinks.write_checked(df, str(tmp_path / "x"), "csv", fill_empty=True)
    back = sinks.read_dataset(df, str(tmp_path / "x"), "csv")
    assert rows(back) == rows(df.fillna("", subset=["k", "v"]))
    assert back.where("n is null").count() == 1


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_order_holds_over_all_files(spark, tmp_path, fmt):
    df = spark.range(0, 5000, 1, 6).select((F.col("id") * 7919 % 5000).alias("k"), F.concat(F.lit("g"), F.col("id") % 3).alias("g"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_checked(df, str(tmp_path / "x"), fmt, order_by=["k"])
        assert len(list((tmp_path / "x").glob("part-*"))) > 1
        sinks.write_checked(df, str(tmp_path / "y"), fmt, order_by=["k"], partition_by=["g"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(p.name for p in (tmp_path / "y").glob("g=*")) == ["g=g0", "g=g1", "g=g2"]
    # the check itself: rows as they came are out of order
    df.write.mode("overwrite").parquet(str(tmp_path / "z"))
    assert sinks._disorder(df, str(tmp_path / "z"), "parquet", ["k"]) > 100


def test_order_between_files_is_checked(spark, tmp_path):
    spark.range(0, 20, 1, 2).write.parquet(str(tmp_path / "y"))
    assert sinks._disorder(spark.range(1), str(tmp_path / "y"), "parquet", ["id"]) == 0
    spark.range(0, 20, 1, 2).select((20 - F.col("id") % 10 - (F.col("id") / 10).cast("long") * 10).alias("id")).write.parquet(str(tmp_path / "z"))
    assert sinks._disorder(spark.range(1), str(tmp_path / "z"), "parquet", ["id"]) == 19


def test_a_loss_is_found(spark, tmp_path, monkeypatch):
    df = spark.range(100)
    plain = sinks._save
    monkeypatch.setattr(sinks, "_save", lambda out, *a: (plain(out, *a), spark.range(99).write.mode("overwrite").parquet(a[0])))
    with pytest.raises(sinks.SinkError, match="rows_written=100, rows_read=99"):
        sinks.write_checked(df, str(tmp_path / "x"))
    monkeypatch.setattr(sinks, "_save", lambda out, *a: (plain(out, *a), spark.range(1, 101).write.mode("overwrite").parquet(a[0])))
    with pytest.raises(sinks.SinkError, match="same_rows=False"):
        sinks.write_checked(df, str(tmp_path / "x"))


def test_empty_and_append(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    for fmt in ("parquet", "csv"):
        assert sinks.write_checked(df, str(tmp_path / fmt), fmt, order_by=["k"]).rows_read == 0
    with pytest.raises(ValueError):
        sinks.write_checked(df, str(tmp_path / "y"), mode="append")
