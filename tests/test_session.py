from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan
from wirecount import session
from wirecount.functions.pin import pinned


def test_a_cluster_without_a_shared_folder_is_refused():
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(master="yarn"),
                              conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(cluster)


def test_the_shared_folder_is_the_one_named(spark):
    folder = session.shared_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir") == folder == session.shared_dir(spark)
    assert spark.sparkContext.getCheckpointDir()


def test_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert session.size_shuffles(spark, 100 << 40) == (100 << 40) // (128 << 20)
    assert session.size_shuffles(spark, 1) == spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_task_reads_a_bounded_part(spark):
    before = spark.conf.get(session.READ)
    for given, want in (("128m", str(session.READ_BYTES)), ("1m", "1m")):
        spark.conf.set(session.READ, given)
        session.configure(spark)
        assert spark.conf.get(session.READ) == want
    spark.conf.set(session.READ, before)


def test_bytes_of_the_input(spark, tmp_path):
    for name, size in (("a", 10), ("b", 32)):
        (tmp_path / name).write_bytes(b"x" * size)
    assert session.input_bytes(spark, str(tmp_path)) == 42
    assert session.input_bytes(spark, f"{tmp_path}/a", f"{tmp_path}/b*") == 42
    assert session.input_bytes(spark, f"{tmp_path}/none") == 0


def test_pinned_values_are_computed_once(spark, tmp_path):
    spark.range(10).selectExpr("cast(id as string) s").write.parquet(str(tmp_path / "s"))
    given = spark.read.parquet(str(tmp_path / "s"))
    df = pinned(given, n=F.length(F.md5(F.col("s").cast("binary"))))
    shown = plan(df.where("n > 3").where("n < 40").select("s", (F.col("n") + 1).alias("m")))
    assert shown.count("md5") == 1
    assert df.where("n = 32").count() == 10
