"""Tensor byte ranges, tiled writing, sample index, prefix scan and moment vectors."""

import datetime as dt
import random

import numpy as np
import pyspark.sql.functions as F
import pytest

from gridloom.operators import grid, moments, scan
from gridloom.operators.samples import SampleIndex, Windowing
from gridloom.session import scratch_path
from gridloom.sources import tensorfiles, tensorsource
from gridloom.sources.dataset import TensorSamples
from gridloom.sources.storage import filesystem, qualified

SHAPE = (6, 3, 2)


def _day(d):
    return dt.date(2024, 1, d)


def _rows(days, drop=(), twice=()):
    rows = [(_day(d), s, 10 * g + 5, None if (d, s, g) == (1, 2, 1) else float(d * 100 + s * 10 + g), float(-s))
            for d in days for s in range(6) for g in range(3) if (d, s, g) not in drop]
    return rows + [r for r in rows if (r[0].day, r[1], (r[2] - 5) // 10) in twice]


def _write(spark, rows, **kw):
    folder = scratch_path(spark, "t-days")
    df = spark.createDataFrame(rows, "date date, step bigint, grid_id bigint, a double, b double")
    status = tensorfiles.write_tensor_days(df, folder, *SHAPE[:2], ["a", "b"], **kw)
    return folder, {r["date"].day: (r["status"], r["reason"]) for r in status.collect()}


def _listed(folder):
    import pyarrow.fs as pafs
    fs, root = filesystem(folder)
    return sorted(i.base_name for i in fs.get_file_info(pafs.FileSelector(root)) if i.base_name.endswith(".bin"))


@pytest.mark.parametrize("tile_steps", [1, 4, None])
def test_only_whole_days_are_published(spark, tile_steps):
    rows = _rows([1, 2, 3, 4], drop={(2, 3, 1)}, twice={(3, 0, 0)})
    rows += [(_day(5), s, 10 * g + 5 + (s == 4), 1.0, 1.0) for s in range(6) for g in range(3)]  # another node in one step
    rows += [(_day(6), 0, 5, 1.0, 1.0)] * 18 + [(None, 0, 5, 1.0, 1.0)]
    folder, status = _write(spark, rows, tile_steps=tile_steps)
    assert status == {1: ("success", None), 2: ("error", "expected 18 rows, got 17"), 3: ("error", "expected 18 rows, got 19"),
                      4: ("success", None), 5: ("error", "steps do not share 3 nodes"), 6: ("error", "expected 18 distinct cells, got 1")}
    assert _listed(folder) == ["20240101.bin", "20240104.bin"]
    got = {(r["date"].day, r["step"]): r["features"] for r in tensorfiles.read_tensor_steps(spark, folder, *SHAPE).collect()}
    assert len(got) == 12 and got[(4, 5)] == [[450.0, -5.0], [451.0, -5.0], [452.0, -5.0]] and got[(1, 2)][1][0] is None
    tensorfiles.write_tensor_days(spark.createDataFrame(_rows([1]), "date date, step bigint, grid_id bigint, a double, b double"),
                                  folder, *SHAPE[:2], ["a", "b"], tile_steps=tile_steps).collect()  # a second run replaces the day
    assert _listed(folder) == ["20240101.bin", "20240104.bin"]


def _planned(spark, folder, filters=(), **options):
    opts = {"path": qualified(spark, folder), "steps": "6", "grids": "3", "features": "2", **{k: str(v) for k, v in options.items()}}
    reader = tensorsource.TensorReader(opts)
    assert list(reader.pushFilters(list(filters))) == list(filters)
    return [(p.day.day, p.first, p.end) for p in reader.partitions()]


def test_byte_ranges_are_planned_and_pruned(spark):
    folder, _ = _write(spark, _rows([1, 2, 4]))
    fs, root = filesystem(folder)
    with fs.open_output_stream(f"{root}/20240109.bin") as f:
        f.write(b"\x00" * 10)
    assert _planned(spark, folder) == [(1, 0, 6), (2, 0, 6), (4, 0, 6)]
    assert _planned(spark, folder, partition_bytes=48) == [(d, s, s + 2) for d in (1, 2, 4) for s in (0, 2, 4)]
    assert _planned(spark, folder, first_day="2024-01-02", last_day="2024-01-03", first_step=3, last_step=3) == [(2, 3, 4)]
    col = lambda n: (n,)
    assert _planned(spark, folder, [tensorsource.In(col("step"), (0, 1, 4)), tensorsource.GreaterThanOrEqual(col("date"), _day(2))]) == \
        [(2, 0, 2), (2, 4, 5), (4, 0, 2), (4, 4, 5)]
    df = tensorfiles.read_tensor_steps(spark, folder, *SHAPE).filter((F.col("step") == 4) & (F.col("date") == F.lit(_day(2))))
    assert [r["features"][0] for r in df.collect()] == [[240.0, -4.0]]
    assert df.rdd.getNumPartitions() == 1  # the filter reached the plan: one byte range, not three files


def _folder(spark):
    folder, _ = _write(spark, _rows([1, 2, 3]))
    times = spark.createDataFrame([(_day(d), dt.datetime(2024, 1, d, s)) for d in (1, 2, 3) for s in range(6)], "date date, ts timestamp_ntz")
    coords = spark.createDataFrame([(25, 3.0, 30.0), (5, 1.0, 10.0), (15, 2.0, 20.0)], "grid_id bigint, lon double, lat double")
    high = spark.createDataFrame([(5, 100.0), (25, 300.0)], "grid_id bigint, elevation double")
    tensorfiles.write_sidecars(spark, folder, times, coords, {"num_features": 2}, elevation=high)
    return folder


def test_samples_by_id(spark):
    folder = _folder(spark)
    data = TensorSamples(spark, folder, *SHAPE, Windowing(2, 1, 2))
    assert len(data) == 3 * 2
    every = {r["sample_id"]: r for r in data.samples().collect()}
    assert sorted(every) == list(range(6))
    assert [(every[i]["date"].day, every[i]["start"]) for i in range(6)] == [(d, s) for d in (1, 2, 3) for s in (0, 2)]
    one = every[3]
    assert [t.hour for t in one["datetime"]] == [2, 3, 4] and one["data"][1][2] == [232.0, -3.0] and one["target"] == [[[240.0, -4.0], [241.0, -4.0], [242.0, -4.0]]]
    for low, high, steps in ((3, 4, 3), (0, 2, 5), (1, 5, 18), (2, 4, 5)):
        assert {r["sample_id"]: r for r in data.samples(low, high).collect()} == {i: every[i] for i in range(low, high)}
        assert data.steps(low, high).count() == steps  # no other step is read
    assert data.samples(6, 9).count() == 0 and data.samples(4, 4).count() == 0
    nodes = [tuple(r) for r in data.coordinates().orderBy("node").collect()]
    assert nodes == [(0, 5, 1.0, 10.0, 100.0), (1, 15, 2.0, 20.0, None), (2, 25, 3.0, 30.0, 300.0)]
    with pytest.raises(ValueError):
        TensorSamples(spark, folder, *SHAPE, Windowing(4, 0, 4), tumbling=True)


def test_index_of_uneven_groups(spark):
    lengths = {"a": 9, "b": 2, "c": 5, "d": 0, "e": 300}
    groups = spark.createDataFrame(list(lengths.items()), "name string, n bigint")
    index = SampleIndex(groups, ["name"], "n", Windowing(3, 1, 2))
    want = [(n, s) for n, size in sorted(lengths.items()) for s in range(0, size - 3, 2)]
    assert len(index) == len(want)
    got = {r["sample_id"]: (r["name"], r["start"]) for r in index.locate().collect()}
    assert got == dict(enumerate(want))
    assert {r["sample_id"]: (r["name"], r["start"]) for r in index.locate(2, 7).collect()} == {i: want[i] for i in range(2, 7)}


def test_prefix_sums_hold_no_whole_table(spark):
    rnd = random.Random(1)
    rows = [(k, rnd.choice([None, rnd.randrange(9)])) for k in rnd.sample(range(10 ** 6), 5000)]
    out = scan.prefix_sums(spark.createDataFrame(rows, "k long, v long"), ["k"], "v")
    total, want = 0, {}
    for k, v in sorted(rows):
        want[k] = total
        total += v or 0
    assert {r["k"]: r["before"] for r in out.collect()} == want
    pos = grid.global_position(spark.range(0, 3000).withColumn("x", (F.col("id") * 7919) % 3001), F.floor(F.col("x") / 10), ["x"])
    plan = pos._jdf.queryExecution().executedPlan().toString()
    assert "Exchange SinglePartition" not in plan
    assert [r["pos"] for r in pos.orderBy("x").collect()] == list(range(3000))
    assert scan.prefix_sums(spark.createDataFrame([], "k long, v long"), ["k"], "v").count() == 0


def test_moments_merge_and_invert(spark):
    rnd = np.random.default_rng(3)
    vecs = [None if i % 50 == 0 else [None if rnd.random() < .1 else float(1e8 + rnd.normal() * (j + 1)) for j in range(4 - i % 2)]
            for i in range(1000)]
    df = spark.createDataFrame([(i, i % 3 if i % 7 else None, v) for i, v in enumerate(vecs)], "i long, g long, v array<double>").repartition(7)

    def want(rows):
        cols = [[v[j] for v in rows if v is not None and len(v) > j and v[j] is not None] for j in range(4)]
        return [(j, len(c), np.mean(c), np.std(c)) for j, c in enumerate(cols)]

    def close(stats, rows):
        for (pos, n, mean, std), w in zip(stats, want(rows), strict=True):
            assert (pos, n) == w[:2] and abs(mean - w[2]) < 1e-6 and abs(std - w[3]) < 1e-6

    close(moments.vector_moments(df, "v").first()["stats"], vecs)
    by = {r["g"]: r["stats"] for r in moments.vector_moments(df, "v", ["g"]).collect()}
    assert set(by) == {None, 0, 1, 2}
    for g in by:
        close(by[g], [v for i, v in enumerate(vecs) if (i % 3 if i % 7 else None) == g])
    z = moments.denormalise(moments.normalise(moments.with_stats(df, "v", ["g"], fit=F.col("i") < 700), "v", "stats", "z"), "z", "stats", "back")
    for r in z.collect():
        if r["v"] is not None:
            assert all((a is None) == (b is None) and (a is None or abs(a - b) < 1e-6) for a, b in zip(r["v"], r["back"]))
    nested = spark.createDataFrame([(1, [[1.0, 5.0], [3.0, 5.0]]), (2, [[5.0, None]])], "i long, v array<array<double>>")
    stats = moments.vector_moments(nested, "v").first()["stats"]
    assert [(s["n"], s["mean"]) for s in stats] == [(3, 3.0), (2, 5.0)] and stats[1]["std"] == 0.0
    assert moments.vector_moments(df.filter("false"), "v").first()["stats"] == []
