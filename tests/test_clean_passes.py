"""The cleaner reads its input once, and a vessel's medians need no pass for the global ones."""

from datetime import datetime

from wakeline.operators import clean as C
from wakeline.operators import vessel as V

COLUMNS = "rid long, mmsi long, ts timestamp, lat double, lon double, sog double, cog double, width double, length double, draught double, shiptype double"


def points():
    rows = []
    for i in range(60):
        width = None if i % 3 == 0 else float(10 + i % 4)
        rows.append((i, 219000001 + i % 4, datetime(2024, 1, 1, i % 24, i % 7), 55.0 + i / 100, 8.0, 1.0, 2.0, width, None if i % 4 == 1 else 40.0 + i, 3.0, None))
    return [*rows, *((r[0] + 1000, *r[1:5], 9.0, *r[6:]) for r in rows[::5])]  # copies: the first row wins


def test_cleaner_reads_its_input_once(spark):
    rows = points()
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    got = C.clean_points(spark.createDataFrame(rows, COLUMNS).mapInArrow(count, COLUMNS)).collect()
    assert read.value == len(rows)
    assert sorted(r.rid for r in got) == list(range(60)) and all(r.sog == 1.0 for r in got)
    assert all(r.width is not None and r.length is not None and r.shiptype == 0.0 for r in got)


def test_key_medians_are_those_of_group_medians(spark):
    df = spark.createDataFrame([*points(), (5000, None, datetime(2024, 1, 1), 55.0, 8.0, 1.0, 2.0, 7.0, None, None, None)], COLUMNS)
    cols = ["width", "length", "draught", "shiptype"]
    per, _ = C.group_medians(df, cols)
    assert sorted(map(str, C.key_medians(df, cols).collect())) == sorted(map(str, per.collect()))


def test_vessel_summary_starts_no_job_before_it_is_read(spark):
    df = spark.createDataFrame(points(), COLUMNS)
    spark.sparkContext.setJobGroup("plan-only", "vessel_summary")
    out = V.vessel_summary(df)
    started = spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(started) == 0 and out.count() == 4
