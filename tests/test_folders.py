"""Single-pass fan-out, commits, counters taken in the same pass."""

import json

import pytest
from pyspark.sql import functions as F

from loomwright.operators.counters import Counters, Progress, by_value
from loomwright.sources import folders, jsonl


def jobs(spark, action):
    """How many jobs ``action`` runs."""
    group = f"g{id(action)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def edits(spark, n=60):
    return spark.range(n).select(
        F.col("id").alias("sample_id"), F.element_at(F.array(F.lit("v1"), F.lit("v2"), F.lit("v9")), (F.col("id") % 3 + 1).cast("int")).alias("branch"),
        F.when(F.col("id") % 5 == 0, "val").otherwise("train").alias("split"),
    )


def ids(spark, path):
    return sorted(r.sample_id for r in spark.read.schema("sample_id long").json(str(path)).collect())


def test_fan_out_in_one_job(spark, tmp_path):
    out = tmp_path / "out"
    targets = folders.branch_targets({"v1": "parameter", "v2": "add", "v3": "delete"}, "everything", ["train", "val"])
    assert jobs(spark, lambda: folders.fan_out(edits(spark), str(out), targets)) == 1
    assert ids(spark, out / "parameter") == list(range(0, 60, 3)) and ids(spark, out / "everything") == list(range(60))
    assert ids(spark, out / "selected_val") == list(range(0, 60, 5)) and ids(spark, out / "delete") == []
    assert json.loads((out / folders.MANIFEST).read_text()) == {"parameter": 20, "add": 20, "delete": 0, "everything": 60, "selected_train": 48, "selected_val": 12}
    folders.fan_out(edits(spark, 9), str(out), targets, append=True)
    assert len(ids(spark, out / "everything")) == 69 and json.loads((out / folders.MANIFEST).read_text())["everything"] == 69
    jsonl.fan_out(edits(spark, 6), str(out), "branch", {"v2": "add"}, "all")
    assert sorted(p.name for p in out.iterdir() if not p.name.startswith((".", "_"))) == ["add", "all"]


def test_a_failed_run_leaves_what_was_there(spark, tmp_path):
    out = str(tmp_path / "out")
    folders.fan_out(edits(spark), out, {"all": F.lit(True)})
    bad = edits(spark, 8).withColumn("x", F.when(F.col("sample_id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.lit("ok")))
    with pytest.raises(Exception, match="broken"):
        folders.fan_out(bad, out, {"all": F.lit(True), "v1": F.col("branch") == "v1"})
    assert ids(spark, f"{out}/all") == list(range(60)) and [p.name for p in tmp_path.iterdir()] == ["out"]


def test_counters_need_no_job_of_their_own(spark, tmp_path):
    counters = Counters("stage", by_value("branch", ["v1", "v2"]), late=F.col("sample_id") >= 50)
    rows = counters.over(edits(spark)).filter("split = 'val'")
    assert jobs(spark, lambda: rows.write.json(str(tmp_path / "rows"))) == 1
    assert counters.read() == {"rows": 60, "v1": 20, "v2": 20, "other": 20, "late": 10} and counters.elapsed >= 0
    with pytest.raises(ValueError):
        counters.over(rows)


def test_streams_report_progress(spark, tmp_path):
    told = []
    listener = Progress(told.append)
    spark.streams.addListener(listener)
    try:
        edits(spark).write.parquet(str(tmp_path / "in"))
        rows = spark.readStream.schema("sample_id long, branch string").parquet(str(tmp_path / "in")).observe("seen", F.count(F.lit(1)).alias("rows"))
        query = rows.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination(60)
        for _ in range(100):
            if told:
                break
            __import__("time").sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert sum(t["counters"]["seen"]["rows"] for t in told if t["counters"]) == 60
