"""Order, grouping and validation of records, on tables made for the rules."""

import pytest
from pyspark.sql import functions as F

from wellspan.functions import names
from wellspan.operators import records

EARLY, LATE = "2024-02-29T23:59:59.123456789+00:00", "2024-03-01T01:59:59.12345679+02:00"


@pytest.mark.parametrize(
    "times,order",
    [
        ([LATE, EARLY], [1, 0]),  # the ninth digit decides
        (["2024-03-01T05:00:00+06:00", "2024-02-29T22:30:00Z", "2024-02-29T23:30:00+00:00"], [1, 0, 2]),
        (["2024-03-01T02:00:00", "2024-03-01T01:00:00.5"], [1, 0]),
        (["2024-03-01T02:00:00", "2024-03-01T01:30:00+09:00"], [1, 0]),  # mixed kinds: by string
        (["x", None, "2024-03-01T02:00:00Z"], [1, 2, 0]),  # unreadable ones: by string, null first
    ],
)
def test_chronological(spark, times, order):
    df = spark.createDataFrame(list(enumerate(times)), "i int, s string")
    assert [r["i"] for r in records.chronological(df, "s").orderBy("rank").collect()] == order


def test_duplicates(spark):
    rows = [(t,) for t in ("2024-03-01T02:00:00.5Z", "2024-03-01T03:00:00.500000000+01:00", EARLY, LATE, "no time", "no time")]
    assert [r["n"] for r in records.duplicate_instants(spark.createDataFrame(rows, "s string"), "s").collect()] == [2]


REC = "acquisition int, begin_time string, row int, column int, field_index int, time_point int, ch int, z_index int, timeline_index int, action_index int, action string, tile_x_index int, tile_y_index int, partial_tile_index int"


def plane(acq=0, field=1, t=1, ch=1, z=1, line=1, index=1, action="2D", tile=None, mosaic=None):
    return (acq, f"b{acq}", 1, 1, field, t, ch, z, line, index, action, *(tile or (None, None)), mosaic)


def test_stacks(spark):
    rows = [plane(line=line, index=index) for line in (1, 2) for index in (1, 2)] + [plane(tile=(x, y), mosaic=3) for x in (2, 7) for y in (1, 4)] + [plane(tile=(9, 9)), plane(field=None)]
    rec = spark.createDataFrame(rows, REC)
    got = records.completeness(records.stack_keys(rec)).collect()
    assert len(got) == 5 and all(r["complete"] for r in got)
    mosaic = next(r for r in got if r["kind"] == "tile")
    assert (mosaic["position"], mosaic["tiles"], mosaic["n"], mosaic["expected"]) == (3, 4, 4, 4)
    placed = records.tile_positions(records.stack_keys(rec).where("kind = 'tile'")).collect()
    assert sorted((r["tile_x_index"], r["gx"], r["tile_y_index"], r["gy"]) for r in placed) == [(2, 0, 1, 0), (2, 0, 4, 1), (7, 1, 1, 0), (7, 1, 4, 1)]
    with pytest.raises(ValueError, match="tile_mode"):
        records.stack_keys(rec, tile_mode="other")


def test_problems(spark):
    fine = [plane(acq=a, field=1, z=z + a) for a in (0, 1) for z in (1, 2)]  # other slices, but as many
    channels = [plane(acq=a, field=2, ch=1 + a) for a in (0, 1)]
    depths = [plane(acq=a, field=3, z=z) for a in (0, 1) for z in range(1 + a)]
    missing = [plane(field=4, t=t, ch=c) for t in (1, 2) for c in (1, 2)][:3]
    twice = [plane(field=5)] * 2
    found = records.stack_problems(records.stack_keys(spark.createDataFrame(fine + channels + depths + missing + twice, REC))).collect()
    assert {r["position"]: r["reason"].split()[0] for r in found} == {2: "acquisitions", 3: "acquisitions", 4: "3", 5: "2"}
    assert records.stack_problems(records.stack_keys(spark.createDataFrame([], REC))).isEmpty()


def test_times_with_gaps(spark):
    rows = [("a", 0, None), ("a", 1, 5.0), ("a", 2, 7.0), ("a", 3, None), ("a", 4, 13.0), ("a", 5, 17.0), ("b", 0, 1.0), ("b", 1, None)]
    timed = records.frame_times(spark.createDataFrame(rows, "k string, t int, s double"), ["k"], ["t"])
    (got,) = records.time_metadata(timed, ["k"], ["t"]).collect()
    assert got.asDict() == {"k": "a", "relative_times": [None, 0.0, 2.0, None, 8.0, 12.0], "frame_intervals": [2.0, 4.0], "time_increment": 3.0, "framerate_hz": 1 / 3}


@pytest.mark.parametrize("n,most,want", [(5, 24, [0, 1, 2, 3, 4]), (25, 8, [0, 3, 6, 10, 13, 17, 20, 24]), (9, 1, [0]), (0, 3, [])])
def test_subsample(spark, n, most, want):
    assert records.evenly(n, most) == want
    df = spark.createDataFrame([(1, i) for i in range(n)], "k int, t int")
    assert sorted(r["t"] for r in records.subsample(df, ["k"], ["t"], most).collect()) == want


def test_numbers_every_row(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("id"), (F.col("id") % 3).alias("x"))
    got = sorted((r["pos"], r["x"], r["id"]) for r in records.numbered(df, ["x", "id"]).collect())
    assert [p for p, _, _ in got] == list(range(1, 1001)) and [g[1:] for g in got] == sorted(g[1:] for g in got)


@pytest.mark.parametrize("well,want", [(" a01 ", (1, 1)), ("P24", (16, 24)), ("Q01", (None, None)), ("A1x", (None, None)), ("", (None, None)), (None, (None, None))])
def test_wells(spark, well, want):
    df = spark.createDataFrame([(well,)], "w string")
    assert tuple(df.select(names.well_row(F.col("w")), names.well_column(F.col("w"))).first()) == want


def test_json_strings(spark):
    import json

    for text in ('a"b\\c\n\t\x01', "é😀\x7f", ""):
        df = spark.createDataFrame([(text,)], "s string")
        assert df.select(names.json_string(F.col("s"))).first()[0] == json.dumps(text)
