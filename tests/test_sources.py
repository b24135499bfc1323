"""CSV sources as files: headers, drops, the merged table."""

import re

import pytest

from wakeline.sources import readers as R


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def sources(tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.csv", "\ufeff# Timestamp,MMSI, Latitude ,Longitude,Route\n2024-01-01 00:00:00,219000001,54.5,8.0,r1\nbad,219000002,1,2,r2\n")
    put(folder, "b.csv", "MMSI,Timestamp,Latitude,Longitude,SOG\n219000001,2024-01-01 02:00:00,54.6,8.1,abc\n,2024-01-01 02:00:00,1,2,3\n219000003.0,2024-01-01 03:00:00,\"54,7\",8.1,7\n")
    put(folder, "c.csv", "MMSI,Timestamp,Latitude,Longitude,SOG\nx,2024-01-01 02:00:00,1,2,3\n219000000,2024-01-02 00:00:00,50,2,3\n")
    put(folder, "empty.csv", "")
    put(folder, "notes.txt", "not a table")
    put(folder, "merged.csv", "MMSI,Timestamp\n1,2024-01-01\n")
    return str(folder)


def test_merge_rows_and_drops(spark, tmp_path):
    folder = sources(tmp_path)
    out = R.merge_sources(spark, folder, f"{folder}/merged.csv")
    got = sorted((r.mmsi, str(r.ts), r.lat, r.route_label, r.sog) for r in out.collect())
    assert got == [(219000000, "2024-01-02 00:00:00", "50", None, "3"), (219000001, "2024-01-01 00:00:00", "54.5", "r1", None),
                   (219000001, "2024-01-01 02:00:00", "54.6", None, "abc"), (219000003, "2024-01-01 03:00:00", "54,7", None, "7")]


def test_written_merge_is_ordered_and_counted(spark, tmp_path):
    folder = sources(tmp_path)
    assert tuple(R.write_merged(spark, folder, f"{folder}/out.csv").first()) == (4, 5, 4, 3)
    # merged.csv was a source here; run again: the output is not one
    assert tuple(R.write_merged(spark, folder, f"{folder}/out.csv").first()) == (4, 5, 4, 3)
    rows = spark.read.option("header", True).csv(f"{folder}/out.csv").collect()
    assert [(r.mmsi, r.ts) for r in rows] == sorted((r.mmsi, r.ts) for r in rows)
    assert all(re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", r.ts) for r in rows)


def test_many_files_plan_as_few_scans(spark, tmp_path):
    folder = tmp_path / "many"
    for i in range(300):
        put(folder, f"f{i:03d}.csv", ("MMSI,Timestamp,Latitude,Longitude\n219000001,2024-01-01 00:00:00,1,2\n" if i % 2
                                      else "Timestamp,MMSI,SOG\n2024-01-01 00:00:00,219000002,3\n"))
    out = R.merge_sources(spark, str(folder))
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2
    assert out.count() == 300


def test_missing_columns_and_files(spark, tmp_path):
    put(tmp_path / "bad", "x.csv", "MMSI,Latitude\n1,2\n")
    with pytest.raises(ValueError, match="x.csv.*ts"):
        R.merge_sources(spark, str(tmp_path / "bad"))
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        R.merge_sources(spark, str(tmp_path / "none"))


def test_read_points_types(spark, tmp_path):
    put(tmp_path / "one", "p.csv", "# Timestamp, MMSI,lat,lng,speed,junk\n2024-01-01 00:00:00,219000001,54.5,8,abc,9\nnope,x,1e400,NaN,3,9\n")
    a, b = R.read_points(spark, str(tmp_path / "one" / "p.csv")).collect()
    assert (a.mmsi, str(a.ts), a.lat, a.lon, a.sog) == (219000001.0, "2024-01-01 00:00:00", 54.5, 8.0, None)
    assert (b.mmsi, b.ts, b.lat, b.lon, b.sog) == (None, None, None, None, 3.0)
    assert "junk" not in a.asDict()
