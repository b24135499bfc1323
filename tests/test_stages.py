"""Stage tables follow their input's files; medians are exact."""

import random
import statistics

from wakeline.operators.medians import exact_medians
from wakeline.operators.ranking import global_row_number
from wakeline.operators.splits import stratified_row_split
from wakeline.plans.stages import stage_table


def test_stage_follows_changed_files(spark, tmp_path):
    folder = str(tmp_path)

    def read():
        return stage_table(spark, "t", folder, lambda: spark.read.parquet(f"{folder}/events.parquet").selectExpr("sum(id) AS s")).first().s

    spark.range(5).write.parquet(f"{folder}/events.parquet")
    assert read() == 10 and read() == 10
    spark.range(7).write.mode("append").parquet(f"{folder}/events.parquet")
    assert read() == 31


def test_exact_medians(spark):
    rnd = random.Random(2)
    cols = {"a": [rnd.gauss(0, 1e3) for _ in range(301)], "b": [rnd.choice([1.0, 2.0, 2.0, 1e300, -1e300]) for _ in range(200)],
            "c": [5.0], "d": [1.0, 2.0], "none": []}
    rows = [(k, v, 1) for k, vs in cols.items() for v in vs] + [("none", None, 3), ("a", None, 9)]
    got = exact_medians(spark.createDataFrame(rows, "name string, value double, n long"))
    assert got == {k: statistics.median(v) for k, v in cols.items() if v}


def test_global_row_number(spark):
    df = spark.createDataFrame([(i * 37 % 501, i % 3) for i in range(500)], "a int, b int")
    got = [(r.a, r.n) for r in global_row_number(df, ["a"], "n").collect()]
    assert sorted(got) == [(a, i + 1) for i, a in enumerate(sorted(x for x, _ in got))]


def test_row_split_keeps_class_shares(spark):
    rows = [(i, "common" if i % 10 else "rare") for i in range(1000)] + [(5000 + i, None) for i in range(10)]
    out = stratified_row_split(spark.createDataFrame(rows, "rid long, label string"), "label", "rid", 0.2)
    got = {(r.label, r.is_test): r["count"] for r in out.groupBy("label", "is_test").count().collect()}
    assert got == {("common", True): 180, ("common", False): 720, ("rare", True): 20, ("rare", False): 80, (None, True): 2, (None, False): 8}
