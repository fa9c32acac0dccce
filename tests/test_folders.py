"""Tables that are folders of files, as larger ones are."""

import os

import pytest

from tests.conftest import SMALL, rows
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("tables"))
    for name in os.listdir(SMALL):
        if name != "documents.parquet":
            os.symlink(f"{SMALL}/{name}", f"{place}/{name}")
    spark.read.parquet(f"{SMALL}/documents.parquet").repartition(3).write.parquet(
        f"{place}/documents.parquet")
    return place


@pytest.mark.parametrize("name", ["stream_hourly_top20", "stream_hourly_by_clock",
                                  "stream_windowed_keywords"])
def test_a_stream_reads_all_files_of_a_table(spark, folder, name):
    assert rows(QUERIES[name](spark, folder)) == rows(QUERIES[name](spark, SMALL)) != []
