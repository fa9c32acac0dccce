"""The whole way, from a channel list and feed documents to a day's keywords."""

import json
from datetime import datetime

import jobs
from tests.conftest import rows
from tests.test_streaming import land
from wirecount.sources import tables

FEED = """<rss><channel><item><title>The rates rise</title>
<pubDate>Mon, 01 Jan 2024 13:15:00 GMT</pubDate></item><item><title>Rates</title>
<pubDate>Mon, 01 Jan 2024 14:15:00 GMT</pubDate></item></channel></rss>"""


def test_all_jobs(spark, database, tmp_path, capsys):
    state, out, topic = str(tmp_path / "state"), str(tmp_path / "out"), str(tmp_path / "topic")
    (tmp_path / "feeds.csv").write_text("title,url,last_updated\nWire,u1,\n")
    landing = tmp_path / "landing" / "channel_id=1"
    landing.mkdir(parents=True)
    (landing / "a.xml").write_text(FEED)

    jobs.main(["create-tables"])
    as_of = ["--as-of", "2024-01-02T01:30:00"]
    assert jobs.main(["add-channels", "--csv", str(tmp_path / "feeds.csv"), "--state", state,
                      *as_of]) == 1
    ingest = ["ingest", "--state", state, "--landing", str(tmp_path / "landing"), "--out", out,
              *as_of]
    assert jobs.main(ingest) == 2
    assert jobs.main(ingest) == 0
    jobs.main(["show-channels", "--state", state])
    assert "1 channels" in capsys.readouterr().out

    sent = [json.loads(r["value"]) for r in spark.read.parquet(out).collect()]
    land(spark, topic, "part=1", sent, datetime(2024, 1, 1, 15, 0, 1))
    hourly = ["hourly", "--path", topic, "--checkpoint", str(tmp_path / "checkpoint"), "--once",
              "--label-from", "published"]
    jobs.main(hourly)
    assert rows(spark.table("keywords_hour").select("hour", "keyword", "count")) == [
        ("2024-01-01 13", "rates", 1), ("2024-01-01 13", "rates rise", 1),
        ("2024-01-01 13", "rise", 1), ("2024-01-01 14", "rates", 1)]
    for more in ([], ["--exact"]):
        assert jobs.main(["rollup", *as_of, *more]) == ["keywords_day"]
        assert spark.table("keywords_day").where("keyword = 'rates'").collect() == [
            ("rates", 2, "2024-01-01 00:00:00")]
    assert jobs.main(["topic-size", "--path", topic, *as_of]) == 2
    seen = {r["name"]: r["value"] for r in spark.table(tables.METRICS).collect()}
    assert seen["channels_new"] == "1" and seen["kafka_messages_total"] == "2"
    kinds = {r["name"]: (r["kind"], r["value"]) for r in spark.table(tables.METRICS).collect()}
    assert kinds["channels_with_news"] == ("set", "1")
    assert kinds["hourly_messages"] == ("counter", "2")
    assert kinds["job_hourly"][0] == "timing" and int(kinds["job_hourly"][1]) > 0
    # The same number from what the hourly stream has noted of its source.
    assert jobs.main(["topic-size"]) == 2
    jobs.main(["expire", "--as-of", "2024-01-04T13:30:00"])
    assert tables.labels(spark, "keywords_hour") == []
    jobs.main(["reset-channels", "--state", state])
    jobs.main(["show-channels", "--state", state])
    assert "0 channels" in capsys.readouterr().out
