"""Sources and sinks on small files written to a fresh folder under the checkpoint root."""

import datetime as dt
import json

import numpy as np
import pyspark.sql.functions as F
import pytest

from gridloom.session import scratch_path
from gridloom.sources import pages, tensorfiles
from gridloom.sources.schemas import FLOW_CELLS, STATION_PAGE


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def test_page_names_parse(spark):
    df = spark.createDataFrame([("page12_rows10000_20240101_000000to20240102_235000.csv",), ("notes.csv",)], "n string")
    r = df.select(*pages.parse_page_name(F.col("n"))).collect()
    assert r[0]["page"] == 12 and r[0]["span_start"] == dt.datetime(2024, 1, 1)
    assert r[0]["span_end"] == dt.datetime(2024, 1, 2, 23, 50)
    assert r[1]["page"] is None


def test_pages_write_read_and_dedup_order(spark):
    root = scratch_path(spark, "t-pages")
    rows = [("2024-01-01 00:00:00", 0, 1.0, 1, 0), ("2024-01-01 00:10:00", 0, 2.0, 1, 1),
            ("2024-01-01 00:10:00", 0, 9.0, 2, 2), ("2024-01-01 00:20:00", 1, 3.0, 2, 3)]
    df = spark.createDataFrame(rows, "DDATETIME string, GRIDID bigint, T double, page bigint, ord bigint")
    for c in STATION_PAGE.fieldNames()[3:]:
        df = df.withColumn(c, F.lit(None).cast("double"))
    written = pages.write_pages(df, root, "page", "ord", STATION_PAGE.fieldNames()).collect()
    assert sorted(w.file_name for w in written) == [
        "page1_rows10000_20240101_000000to20240101_001000.csv",
        "page2_rows10000_20240101_001000to20240101_002000.csv"]
    back = pages.read_pages(spark, root)
    assert back.count() == 4
    from gridloom.operators.dedup import dedup_keep_first
    d = dedup_keep_first(back, ["ts", "GRIDID"], ["span_start", "page", "row_ord"])
    t = {r["ts"].minute: r["T"] for r in d.collect()}
    assert t == {0: 1.0, 10: 2.0, 20: 3.0}
    listed = pages.list_pages(spark, root).collect()
    assert {r["page"] for r in listed} == {1, 2}


def test_pages_by_header_name_and_file_report(spark):
    """A stray file, a reordered header, a page without the time column and a bad time."""
    import os

    root = scratch_path(spark, "t-headers")
    local = root.removeprefix("file:")
    os.makedirs(local)
    files = {"page1_rows10000_20240101_000000to20240101_001000.csv": "DDATETIME,GRIDID,T,MAXTOFDAY\n2024-01-01 00:00:00,0,11,30\nnever,0,1,1\n",
             "page2_rows10000_20240101_001000to20240101_002000.csv": "GRIDID,MAXTOFDAY,DDATETIME,T,EXTRA\n1,40,2024-01-01 00:10:00,20,x\n",
             "page3_rows10000_20240101_002000to20240101_003000.csv": "GRIDID,T\n1,20\n",
             "notes_copy.csv": "DDATETIME,GRIDID,T\n2024-01-01 00:00:00,0,99\n"}
    for name, text in files.items():
        with open(f"{local}/{name}", "w") as f:
            f.write(text)
    rows = {(r["page"], r["ts"].minute if r["ts"] else None): (r["GRIDID"], r["T"]) for r in pages.read_pages(spark, root).collect()}
    assert rows == {(1, 0): (0, 11.0), (1, None): (0, 1.0), (2, 10): (1, 20.0)}
    report = {r["file_name"].split("_")[0]: tuple(r)[1:] for r in pages.file_report(spark, root).collect()}
    assert report == {"page1": ("read", 2, 0, 1), "page2": ("read", 1, 0, 0), "page3": ("no time column", 0, 0, 0), "notes": ("not a page", 0, 0, 0)}


def test_odd_page_files(spark):
    """A byte order mark, CRLF, quoted fields, a ragged line, no rows, nothing at all, bad text, numbers that aren't."""
    import os

    root = scratch_path(spark, "t-odd")
    local = root.removeprefix("file:")
    os.makedirs(local)
    name = "page{}_rows10000_20240101_000000to20240101_001000.csv".format
    files = {name(1): "\ufeffDDATETIME,GRIDID,T\r\n2024-01-01 00:00:00,0,1.5\r\n2024-01-01 00:10:00,1\r\n2024-01-01 00:20:00,2,2.5\r\n".encode(),
             name(2): b'"DDATETIME","GRIDID","T","T"\n"2024-01-01 00:00:00",x,7,8\nDDATETIME,1,,9\n',
             name(3): b"DDATETIME,GRIDID,T", name(4): b"", name(5): b"DDATETIME,GRIDID,T\n2024-01-01 00:00:00,1,\xff\xfe\n"}
    for n, content in files.items():
        with open(f"{local}/{n}", "wb") as f:
            f.write(content)
    rows = sorted((r["page"], r["row_ord"], r["GRIDID"], r["T"], r["ts"] is None) for r in pages.read_pages(spark, root).collect())
    assert rows == [(1, 0, 0, 1.5, False), (1, 1, 2, 2.5, False), (2, 0, None, 7.0, False), (2, 1, 1, None, True)]
    report = {int(r["file_name"][4]): tuple(r)[1:] for r in pages.file_report(spark, root).collect()}
    assert report == {1: ("read", 2, 1, 0), 2: ("read", 2, 0, 1), 3: ("read", 0, 0, 0), 5: ("unreadable", 0, 0, 0)}


def test_tensor_writer_refuses_misaligned_days(spark):
    from gridloom.sources import tensorfiles as tf

    rows = [("2024-01-01", 0, 0, 1.0), ("2024-01-01", 0, 1, 2.0), ("2024-01-02", 0, 0, 1.0), ("2024-01-02", 0, 0, 2.0),
            ("2024-01-03", 0, 0, 1.0)]
    df = spark.createDataFrame(rows, "d string, step bigint, grid_id bigint, v double").withColumn("date", F.to_date("d")).drop("d")
    got = {r["file_name"]: (r["status"], r["reason"]) for r in tf.write_tensor_days(df, scratch_path(spark, "t-bad").removeprefix("file:"), 1, 2, ["v"]).collect()}
    assert got == {"20240101.bin": ("success", None), "20240102.bin": ("error", "expected 2 distinct cells, got 1"),
                   "20240103.bin": ("error", "expected 2 rows, got 1")}


def test_json_pages_empty_page_yields_nothing(spark):
    from pyspark.sql import types as T
    row = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    docs = spark.createDataFrame([(1, json.dumps({"data": [{"a": 1, "b": "x"}, {"a": 2, "b": None}]})),
                                  (2, json.dumps({"data": []})), (3, "not json")], "page int, value string")
    out = pages.parse_json_pages(docs, row).orderBy("a").collect()
    assert [(r["page"], r["a"], r["b"]) for r in out] == [(1, 1, "x"), (1, 2, None)]


def test_grid_info_headers(spark):
    root = scratch_path(spark, "t-grid")
    heads = list(pages.GRID_HEADERS)
    df = spark.createDataFrame([(2, 1.0, 2.0, 1.5, 2.5, "c2", 0, 1), (1, 0.0, 0.0, 0.5, 0.5, "c1", 0, 0)],
                               ", ".join(f"`{h}` {t}" for h, t in zip(heads, ["bigint", "double", "double", "double",
                                                                         "double", "string", "int", "int"])))
    df.coalesce(1).write.option("header", True).csv(root)
    g = pages.read_grid_info(spark, root).collect()
    assert [r["grid_id"] for r in g] == [1, 2] and g[1]["lon_max"] == 1.5 and len(g[0]) == 5


def test_tensor_files_round_trip_and_bad_size(spark):
    root = scratch_path(spark, "t-tensor")
    rows = [(dt.date(2024, 1, 1), s, g, float(s * 10 + g), float(-g)) for s in range(3) for g in range(2)]
    rows.append((dt.date(2024, 1, 2), 0, 0, 1.0, 1.0))        # an incomplete day: not written
    df = spark.createDataFrame(rows, "date date, step bigint, grid_id bigint, a double, b double")
    status = {r["date"]: r["status"] for r in tensorfiles.write_tensor_days(df, root, 3, 2, ["a", "b"]).collect()}
    assert status == {dt.date(2024, 1, 1): "success", dt.date(2024, 1, 2): "error"}
    with open(_local(root) + "/20240101.bin", "rb") as f:
        arr = np.frombuffer(f.read(), dtype=np.float32).reshape(3, 2, 2)
    assert arr[2, 1, 0] == 21.0 and arr[1, 1, 1] == -1.0
    with open(_local(root) + "/20240103.bin", "wb") as f:     # a file of the wrong size
        f.write(b"\x00" * 10)
    long, report = tensorfiles.read_tensor_days(spark, root, 3, 2, 2)
    assert long.count() == 12
    rep = {r["stem"]: r["status"] for r in report.collect()}
    assert rep == {"20240101": "success", "20240103": "error"}
    eq = tensorfiles.round_trip_equal(
        df.filter("date = '2024-01-01'").select("date", "step", F.col("grid_id").alias("node"),
                                                F.lit(0).cast("bigint").alias("feature"), F.col("a").alias("value")),
        long.filter("feature = 0"), ["date", "step", "node", "feature"], "value").first()
    assert eq["equal"]


def test_time_index_round_trip(spark):
    root = scratch_path(spark, "t-index")
    times = spark.createDataFrame([(dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, h)) for h in (2, 0, 1)],
                                  "date date, ts timestamp_ntz")
    coords = spark.createDataFrame([(0, 1.0, 2.0)], "grid_id bigint, lon double, lat double")
    tensorfiles.write_sidecars(spark, root, times, coords, {"num_features": 1})
    idx = tensorfiles.read_time_index(spark, f"{root}/time_index").orderBy("step").collect()
    assert [(r["step"], r["ts"].hour) for r in idx] == [(0, 0), (1, 1), (2, 2)]
    assert tensorfiles.read_metadata(spark, f"{root}/metadata") == {"num_features": 1}


def test_feature_schema_validation():
    FLOW_CELLS.validate()
    assert len(FLOW_CELLS.columns) == 29 and len(FLOW_CELLS.features) == 16
    from dataclasses import replace
    with pytest.raises(ValueError):
        replace(FLOW_CELLS, grad_dim=7).validate()


def test_tensor_reader_requires_a_valid_file(spark):
    root = scratch_path(spark, "t-tensor-bad")
    spark.createDataFrame([(b"\x00" * 12,)], "b binary").write.parquet(root + "/x")  # a folder with no .bin file
    with open(_local(root) + "/20240101.bin", "wb") as f:
        f.write(b"\x00" * 8)
    with pytest.raises(ValueError):
        tensorfiles.read_tensor_days(spark, root, 3, 2, 2, require_any=True)


def test_series_slots_and_public_descriptors(spark):
    from gridloom.sources import catalog as cat

    def series(name, minutes, nodes=1):
        start = dt.datetime(2024, 1, 1)
        return [(name, k, start + dt.timedelta(minutes=m), n, 0, 1.0) for k, m in enumerate(minutes) for n in range(nodes)]

    rows = series("whole", [0, 60, 120]) + series("off", [0, 30, 120]) + series("gap", [0, 60, 180]) + series("short", [0, 60], 2)[:3]
    long = spark.createDataFrame(rows, "dataset string, step bigint, ts timestamp_ntz, node bigint, channel bigint, value double")
    untimed = spark.createDataFrame([("steps", k, None, 0, 0, 1.0) for k in (0, 1, 3)], long.schema)
    names = [("whole", 1), ("off", 1), ("gap", 1), ("short", 2), ("steps", 1), ("none", 1)]
    got = {r["name"]: r for r in cat.validate(long.unionByName(untimed), [cat.Descriptor(n, "node_frame", 60, k, 1) for n, k in names]).collect()}
    assert {n: r["status"] for n, r in got.items()} == {"whole": "ok", "off": "irregular", "gap": "irregular", "short": "mismatch",
                                                        "steps": "irregular", "none": "absent"}
    assert (got["off"]["off_slot"], got["off"]["span_steps"], got["gap"]["off_slot"], got["gap"]["span_steps"]) == (1, 3, 0, 4)
    assert len(cat.PUBLIC_SERIES) == 15 and cat.descriptor("weather").channels == 21
    with pytest.raises(ValueError):
        cat.descriptor("unknown")
