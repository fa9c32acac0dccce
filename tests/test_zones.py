"""Clocks, bounds and samples mean UTC in a process of another zone."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
from datetime import datetime, timedelta
from pyspark.sql import functions as F
from wirecount.functions import times
from wirecount.operators import messages, metrics, series
from wirecount.session import create

spark = create("zones", "local[1]", **{"spark.ui.enabled": "false",
                                       "spark.sql.shuffle.partitions": "1"})
noon = datetime(2024, 1, 10, 12, 10)
label = spark.range(1).select(times.label(times.instant(noon))).first()[0]
assert label == "2024-01-10 12", label
points = spark.sql("SELECT timestamp'2024-01-10 12:30:00' AS t, 1 AS v")
start, end = datetime(2024, 1, 10, 12), datetime(2024, 1, 10, 13)
assert series.time_range(points, "t", start, end).count() == 1
points.createOrReplaceTempView("points")
panel = series.panel_sql(
    spark, "SELECT v FROM points WHERE t > $__timeFrom AND t < $__timeTo "
    "AND unix_seconds(t) > $__unixEpochFrom AND unix_seconds(t) < $__unixEpochTo", start, end)
assert panel.count() == 1
kept = messages.newer_than(points, F.col("t"), end, timedelta(minutes=40))
assert kept.count() == 1
assert messages.newer_than(points, F.col("t"), end, timedelta(minutes=20)).count() == 0
assert messages.newest(points, "t").isoformat() == "2024-01-10T12:30:00+00:00"
sample = metrics.samples(spark, noon, "gauge", x=1)
assert sample.select(F.date_format("ts", "HH:mm")).first()[0] == "12:10"
spark.stop()
"""


def test_another_zone():
    root = str(Path(__file__).resolve().parent.parent)
    env = {**os.environ, "TZ": "Europe/Berlin", "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", SCRIPT], env=env, cwd=root, timeout=240,
                          capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
