"""Text feeds: headers of any order, missing files and columns, quarantined rows."""

import pytest

from pickwise.sources import gtfs_text as G


def put(root, bundle, table, text, part=None):
    folder = root / bundle if part is None else root / bundle / f"{table}.txt"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / (f"{table}.txt" if part is None else part)).write_text(text)


@pytest.fixture
def root(tmp_path):
    put(tmp_path, "june", "stops", "stop_id,stop_name,stop_lat,stop_lon\ns1,\"Main, St\",40.5,-74\ns2,Two,north,-74.5\n,None,1,2\n")
    put(tmp_path, "june", "calendar_dates", "service_id,date,exception_type\nWK,20240101,1\n")
    put(tmp_path, "ju+ly [2]", "stops", "\ufeffstop_lon, stop_name ,x_extra,stop_id\n-74.1,Three,?,s3\n-74.2,Four,s4\n-74.3,Five,?,s5,9\n")
    put(tmp_path, "parts", "stops", "stop_id,stop_name\na,A\n", "p0.csv")
    put(tmp_path, "parts", "stops", "stop_name,stop_id\nB,b\n", "p1.csv")
    put(tmp_path, "parts", "trips", "")
    put(tmp_path, "parts", "unknown", "a,b\n1,2\n")
    return tmp_path


def test_index_lists_each_file_with_its_header(spark, root):
    got = {(f["bundle"], f["table"]): f["header"] for f in G.feed_index(spark, str(root))}
    assert len(G.feed_index(spark, str(root))) == 5
    assert got["ju+ly [2]", "stops"] == ["stop_lon", "stop_name", "x_extra", "stop_id"] and got["june", "calendar_dates"] == ["service_id", "date", "exception_type"]
    assert ("parts", "trips") not in got and ("parts", "unknown") not in got
    assert {f["bundle"] for f in G.feed_index(spark, str(root), ["ju+ly [2]", "absent"])} == {"ju+ly [2]"}
    assert G.feed_index(spark, str(root / "nowhere")) == []


def test_small_splits_give_the_same_index(spark, root):
    put(root, "big", "stops", "stop_id,stop_name\n" + "".join(f"s{i},name {i}\n" for i in range(5000)))
    want = G.feed_index(spark, str(root))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        assert G.feed_index(spark, str(root)) == want and len(want) == 6
        assert G.read_feeds(spark, str(root), ["big"]).tables.stops.distinct().count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_feeds_may_lack_tables_and_columns(spark, root):
    feeds = G.read_feeds(spark, str(root))
    stops = {(r.bundle, r.stop_id): (r.stop_name, r.stop_lat, r.stop_lon, r.location_type) for r in feeds.tables.stops.collect()}
    assert stops == {("june", "s1"): ("Main, St", 40.5, -74.0, None), ("june", "s2"): ("Two", None, -74.5, None), ("ju+ly [2]", "s3"): ("Three", None, -74.1, None),
                     ("parts", "a"): ("A", None, None, None), ("parts", "b"): ("B", None, None, None)}
    assert [tuple(r) for r in feeds.tables.calendar_dates.collect()] == [("june", "WK", 20240101, 1)]
    for name, schema in G.TEXT_SCHEMAS.items():
        table = getattr(feeds.tables, name)
        assert table.dtypes == [("bundle", "string"), *schema.items()]
    assert feeds.tables.trips.count() == feeds.tables.shapes.count() == 0


def test_quarantine_says_what_and_why(spark, root):
    bad = G.read_feeds(spark, str(root)).quarantine.collect()
    assert sorted((r.bundle, r.table_name, r.reason, r.column_name, r.value) for r in bad if r.reason != G.WRONG_FIELDS) == [
        ("june", "stops", G.NO_KEY, "stop_id", None), ("june", "stops", G.WRONG_TYPE, "stop_lat", "north")]
    assert sorted(r.value for r in bad if r.reason == G.WRONG_FIELDS) == ["-74.2,Four,s4", "-74.3,Five,?,s5,9"]
    assert all(r.file.endswith("stops.txt") for r in bad)
    assert G.read_feeds(spark, str(root / "nowhere")).quarantine.count() == 0


def test_written_feed_reads_back(spark, tmp_path):
    stops = spark.createDataFrame([("b", 's"1', "a, \"b\"", 1.5, None), ("b", "s2", None, None, 2.0), ("c", "s3", "x", 0.0, 0.0)], "bundle string, stop_id string, stop_name string, stop_lat double, stop_lon double")
    G.write_feed(G.GtfsTables(stops=stops), str(tmp_path), "b", columns={"stops": ["stop_lon", "stop_name", "stop_id", "stop_lat"]})
    feeds = G.read_feeds(spark, str(tmp_path))
    back = feeds.tables.stops.select(stops.columns)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, stops.where("bundle = 'b'").collect()), key=str)
    assert feeds.quarantine.count() == 0
