"""Streaming jobs: runs over several arrivals, late rows, repeated batches."""

import datetime as dt
import uuid

import pytest

from wakeline.streaming import ais_stream as ST

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "mmsi double, ts timestamp, lat double, lon double, sog double, cog double, width double, length double, draught double"


def row(m, minutes, sog=0.5, lat=54.0):
    return (200000000.0 + m, T0 + dt.timedelta(minutes=minutes), lat, 8.0, sog, 10.0, 5.0, 50.0, 3.0)


FIRST = [row(1, 0), row(1, 30), row(1, 70, 4.0), row(2, 10), row(2, 20, lat=95.0), row(1, 600), row(2, 650)]
SECOND = [row(1, 590, 0.7), row(2, 655), row(1, 700), row(3, 640, 20.0)]  # some before the latest of the first, within the watermark
THIRD = [row(1, 3000), row(2, 3000), row(1, 3001)]


def arrive(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(path))


def hours(spark, path, name):
    stream = ST.hourly_resample_stream(ST.read_point_stream(spark, str(path), SCHEMA))
    return ST.latest(ST.run_available_now(stream, name, "update"), ["mmsi", "ts"])


def stops(spark, path, name):
    stream = ST.stop_events_stream(ST.read_point_stream(spark, str(path), SCHEMA))
    return ST.run_available_now(stream, name).drop("epoch")


def values(df):
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def test_nothing_has_arrived(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert hours(spark, tmp_path / "in", uuid.uuid4().hex).count() == 0


def test_runs_arrive_at_the_batch_result(spark, tmp_path):
    path, name = tmp_path / "in", uuid.uuid4().hex
    finished = []
    for rows in (FIRST, SECOND, THIRD):
        arrive(spark, path, rows)
        points = spark.read.parquet(str(path))
        batch = ST.hourly_resample_stream(points)
        assert values(hours(spark, path, f"h-{name}")) == values(batch)
        closed = stops(spark, path, f"s-{name}")
        slow = points.where("sog <= 1")
        assert values(ST.with_open_stops(closed, points)) == values(ST._stops(slow, 3 * 3600))
        finished.append(closed.count())
    assert finished[0] < finished[2]  # the watermark has passed the early ones
    assert values(hours(spark, path, f"h-{name}")) == values(batch)  # nothing new


@pytest.mark.parametrize("kind", [hours, stops])
def test_a_killed_batch_counts_once(spark, tmp_path, monkeypatch, kind):
    path, name = tmp_path / "in", uuid.uuid4().hex
    arrive(spark, path, FIRST)
    arrive(spark, path, THIRD)
    write = ST._write_epoch

    def killed(batch, epoch, out):
        write(batch, epoch, out)
        raise RuntimeError("killed after writing")

    monkeypatch.setattr(ST, "_write_epoch", killed)
    with pytest.raises(Exception, match="killed after writing"):
        kind(spark, path, name)
    monkeypatch.setattr(ST, "_write_epoch", write)
    got = values(kind(spark, path, name))
    assert got and got == values(kind(spark, path, uuid.uuid4().hex)) and len(got) == len(set(got))
