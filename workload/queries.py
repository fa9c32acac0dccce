"""Registered queries: every one applies library operators to whole tables."""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wirecount.functions import text, times
from wirecount.operators import keywords as kw, messages as msg, metrics, registry as reg, series
from wirecount.operators.rollup import keywords_per, label_range, roll_up, roll_up_scheduled
from wirecount.plans import rollups
from wirecount.session import scratch_dir
from wirecount.sources import tables
from wirecount.sources.channels import read_channels
from workload import inputs

QUERIES = {}

RANGE = (datetime(2024, 1, 5, 6, 0), datetime(2024, 1, 20, 18, 0))
NIGHT = (datetime(2024, 1, 9, 22, 0), datetime(2024, 1, 11, 3, 0))
LABELS = ("2024-01-28 01:30:00", "2024-01-31 00:00:00")
ALL_TIME = (datetime(2020, 1, 1), datetime(2030, 1, 1))
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _kept(rows: DataFrame) -> DataFrame:
    """Rows of a table that is about to go, in a folder of their own."""
    folder = f"{scratch_dir(rows.sparkSession)}/rows"
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


@contextmanager
def _database(spark: SparkSession, folder: str):
    """Fresh keyword tables in the shared folder, as the current database."""
    name = f"wirecount_{uuid.uuid4().hex}"
    previous = spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/tables'")
    spark.catalog.setCurrentDatabase(name)
    try:
        tables.create_tables(spark)
        yield name
    finally:
        spark.catalog.setCurrentDatabase(previous)
        spark.sql(f"DROP DATABASE {name} CASCADE")


def micros(column: str):
    return F.unix_micros(column).alias(column)


# Text and keywords

@query
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.documents(spark, sf_dir).select("doc_id", "text")
    words = docs.withColumn("t", text.tokens(F.col("text")))
    return words.select("doc_id", F.size("t").cast("long").alias("n_tokens"),
                        F.array_join("t", " ").alias("tokens"))


@query
def tokenize_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.documents(spark, sf_dir).select("doc_id", "text")
    words = docs.withColumn("t", text.tokens(F.col("text"), "clean"))
    return words.select("doc_id", F.size("t").cast("long").alias("n_tokens"),
                        F.array_join("t", " ").alias("tokens"))


@query
def trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kw.keyword_counts(inputs.headlines(spark, sf_dir), sizes=(3,))


@query
def stopword_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.documents(spark, sf_dir).select("doc_id", "text")
    kept = kw.stop_rows(kw.token_rows(docs, title="text"), inputs.stop_words(spark))
    return kept.groupBy("token").agg(F.count("*").alias("count"))


@query
def lemma_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.documents(spark, sf_dir).select("doc_id", "text")
    counted = kw.token_rows(docs, title="text").groupBy("token").agg(F.count("*").alias("count"))
    return kw.lemma_counts(counted, inputs.lemmas(spark, sf_dir))


@query
def unigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kw.keyword_counts(inputs.headlines(spark, sf_dir), sizes=(1,))


@query
def bigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kw.keyword_counts(inputs.headlines(spark, sf_dir), sizes=(2,))


@query
def keyword_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kw.keyword_counts(inputs.headlines(spark, sf_dir))


@query
def keyword_counts_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kw.keyword_counts(
        inputs.headlines(spark, sf_dir), stop_words=inputs.STOP_WORDS,
        lemmas=inputs.lemmas(spark, sf_dir))


@query
def keyword_counts_cleaned_by_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kw.keyword_counts(
        inputs.headlines(spark, sf_dir), stop_words=inputs.stop_words(spark),
        lemmas=inputs.lemmas(spark, sf_dir), max_listed=0, max_bytes=0)


@query
def keyword_counts_distinct_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kw.keyword_counts(inputs.headlines(spark, sf_dir), dedupe_titles=True)


@query
def keyword_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kw.top_keywords(inputs.headlines(spark, sf_dir))


@query
def hour_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = inputs.shaped_headlines(
        inputs.documents(spark, sf_dir).select("doc_id", "text", "source"))
    ts = F.col("published")
    return heads.select(
        "doc_id", times.label(ts).alias("hour"), times.label(ts, "hour", "end").alias("hour_end"),
        times.label(ts, "day").alias("day"), times.label(ts, "month", "end").alias("month_end"))


@query
def hourly_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords_per(inputs.headlines(spark, sf_dir), "hour")


@query
def latest_hour_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = inputs.headlines(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "published"))
    newest = heads.agg(F.max("hour")).scalar()
    counts = kw.keyword_counts(heads.where(F.col("hour") == newest), by=["hour"])
    return kw.top_k(counts).withColumn("hour", times.label(F.col("hour")))


# Rollups

@query
def daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roll_up(hourly_top20(spark, sf_dir), "day")


@query
def monthly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roll_up(daily_rollup(spark, sf_dir), "month")


@query
def daily_rollup_end_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = keywords_per(inputs.headlines(spark, sf_dir), "hour", label_at="end")
    return roll_up(hourly, "day", label_at="end")


@query
def daily_rollup_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roll_up(hourly_top20(spark, sf_dir), "day", as_of=datetime(2024, 2, 1, 1, 30))


@query
def daily_rollup_scheduled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roll_up_scheduled(hourly_top20(spark, sf_dir), "day")


@query
def monthly_rollup_scheduled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roll_up_scheduled(daily_rollup_scheduled(spark, sf_dir), "month")


@query
def monthly_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords_per(inputs.headlines(spark, sf_dir), "month")


@query
def label_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_range(hourly_top20(spark, sf_dir), "hour", *LABELS)


@query
def label_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = inputs.events(spark, sf_dir).select(F.date_trunc("day", "ts").alias("d")).distinct()
    run = days.select((F.col("d") + F.expr("INTERVAL 90 MINUTES")).alias("as_of"))
    columns = times.calendar(F.col("as_of"))
    return run.select(F.date_format("as_of", "yyyy-MM-dd HH:mm:ss").alias("as_of"),
                      *(c.alias(n) for n, c in columns.items()))


# Messages

@query
def json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = msg.parse_messages(inputs.topic(spark, sf_dir), keep=("key",))
    return parsed.select("key", "id", "title", F.unix_millis("published").alias("published"),
                         "ChannelTitle", "reject_reason")


@query
def message_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = msg.to_messages(inputs.messages(inputs.headlines(spark, sf_dir)))
    got = msg.accepted(msg.parse_messages(sent, keep=("key", "topic")))
    return got.select("key", "topic", "id", "title", F.unix_millis("published").alias("published"),
                      "ChannelTitle")


@query
def published_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, later = F.col("ts"), F.col("ts") + F.expr("INTERVAL 2 HOURS")
    iso, mail = "yyyy-MM-dd'T'HH:mm:ss", "EEE, d MMM yyyy HH:mm:ss "
    forms = {
        "iso": F.date_format(ts, iso + "'Z'"),
        "iso_offset": F.concat(F.date_format(later, iso), F.lit("+02:00")),
        "iso_bare": F.date_format(ts, iso),
        "mail": F.concat(F.date_format(ts, mail), F.lit("GMT")),
        "mail_offset": F.concat(F.date_format(later, mail), F.lit("+0200")),
        "mail_zone": F.concat(F.date_format(ts, mail), F.lit("EST")),
        "year": F.date_format(ts, "yyyy"),
    }
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("form"), c.alias("published"))
                               for n, c in forms.items())))
    given = inputs.events(spark, sf_dir).select("event_id", "ts")
    rows = given.select("event_id", each.alias("e")).select("event_id", "e.*")
    published = F.col("published")
    return rows.select(
        "event_id", "form", times.published_millis(published).alias("epoch_ms"),
        times.published_iso(published).alias("iso"),
        times.published_iso(published, wall_clock=True).alias("wall"))


@query
def blank_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    kind = F.col("event_id") % 7
    written = (F.when(kind == 0, "").when(kind == 1, F.concat(F.lit(" "), user, F.lit(" ")))
               .when(kind == 2, F.concat(F.lit("x"), user)).otherwise(user))
    return inputs.events(spark, sf_dir).select(
        "event_id", times.blank_to(written, 0).alias("last_updated"))


@query
def message_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = inputs.messages(inputs.headlines(spark, sf_dir))
    once = msg.dedup(sent.unionByName(sent))
    return once.withColumn("published", F.unix_millis("published"))


@query
def titles_per_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = kw.titles_in_chunks(inputs.headlines(spark, sf_dir), ["ChannelTitle"], chunk_size=25)
    titles = F.transform("titles", lambda t: F.concat_ws(" x ", t["title"], t["n"]))
    return chunks.select(
        "ChannelTitle", F.col("chunk").cast("long").alias("chunk"),
        F.size("titles").cast("long").alias("n_titles"),
        F.array_join(titles, "\n").alias("titles"))


@query
def topic_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.topic_size(inputs.offsets(spark, sf_dir))


@query
def messages_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.messages_per_hour(inputs.events(spark, sf_dir), "ts")


@query
def ttl_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.events(spark, sf_dir)
    kept = msg.newer_than(rows, F.col("ts"), msg.newest(rows, "ts"), timedelta(seconds=172800))
    return kept.select("event_id", micros("ts"), "user_id", "event_type", "value")


@query
def retained_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = inputs.offsets(spark, sf_dir)
    recent = msg.newer_than(held, F.col("timestamp"), msg.newest(held, "timestamp"),
                            timedelta(hours=24))
    return msg.topic_size(recent)


# Registry and ingest

@query
def registry_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.channel_registry(spark, sf_dir)


@query
def channel_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.channel_registry(spark, sf_dir).agg(F.count("*").alias("channels"))


@query
def channel_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.insert_channels(inputs.channel_candidates(spark, sf_dir),
                               inputs.channel_registry(spark, sf_dir), ["position"])


@query
def channel_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/channels"
    listed = inputs.channel_candidates(spark, sf_dir)
    mark = (F.when(F.col("position") % 5 == 0, "").when(F.col("position") % 5 == 1, "soon")
            .otherwise(F.col("position").cast("string")))
    # Other columns in another order, and a line break inside a quoted title.
    listed.select("url", F.lit("x").alias("note"), mark.alias("last_updated"),
                  F.concat(F.lit('say, "'), "title", F.lit('"\nagain')).alias("title")
                  ).write.option("escape", '"').csv(path, header=True)
    return read_channels(spark, path).select("title", "url", "last_updated", "reject_reason")


@query
def registry_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = inputs.channel_candidates(spark, sf_dir)
    return reg.registry_faults(candidates.withColumnRenamed("position", "id"))


def _fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.new_entries(reg.read_entries(inputs.entries(spark, sf_dir)),
                           inputs.reader_registry(spark, sf_dir))


@query
def incremental_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.entry_messages(_fresh(spark, sf_dir)).withColumn(
        "published", F.unix_millis("published"))


@query
def incremental_new_by_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = reg.new_entries(reg.read_entries(inputs.entries(spark, sf_dir)),
                            inputs.reader_registry(spark, sf_dir), max_bytes=0)
    return reg.entry_messages(fresh).withColumn("published", F.unix_millis("published"))


@query
def new_message_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fresh(spark, sf_dir).agg(F.count("*").alias("new_messages"))


@query
def registry_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.advance_marks(inputs.reader_registry(spark, sf_dir), _fresh(spark, sf_dir))


@query
def entries_at_the_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channels marked with the time of one of their entries: how many entries are later, and how
    many when the one at the mark is taken too."""
    read = reg.read_entries(inputs.entries(spark, sf_dir))
    good = read.where(F.col("reject_reason").isNull())
    marks = good.groupBy("channel_id").agg(F.percentile_approx("published_ms", 0.5).alias("m"))
    registry = inputs.reader_registry(spark, sf_dir).join(
        marks.withColumnRenamed("channel_id", "id"), "id").select(
        "id", "title", "url", F.col("m").alias("last_updated"))

    def counted(at_mark, name):
        return reg.new_entries(read, registry, at_mark=at_mark).groupBy("channel_id").agg(
            F.count("*").alias(name))

    both = counted(True, "from_mark").join(counted(False, "after_mark"), "channel_id", "left")
    return both.select("channel_id", "from_mark",
                       F.coalesce("after_mark", F.lit(0)).alias("after_mark"))


@query
def landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries landed as feed documents, a first part and all of them, ingested by three runs of
    which the last finds nothing new: the marks they leave."""
    from wirecount.plans import ingest
    from wirecount.sources import snapshots

    scratch = scratch_dir(spark)
    snapshots.publish_channels(inputs.reader_registry(spark, sf_dir), scratch, strict=False)

    # Files are written one after another by a task, so all tasks have some, also of small rows.
    tasks = spark.sparkContext.defaultParallelism
    documents = inputs.feed_documents(inputs.entries(spark, sf_dir))
    send = ingest.to_folder(f"{scratch}/messages")
    for part in (F.col("channel_id") % 2 == 0, F.col("channel_id") % 2 == 1, F.lit(False)):
        # A row is a document and gets a file of its own.
        inputs.land(documents.where(part).repartition(tasks, "channel_id")
                    .sortWithinPartitions("channel_id"), f"{scratch}/landing")
        ingest.ingest_landed(spark, f"{scratch}/landing", scratch, send)
    return snapshots.load_registry(spark, scratch).select("id", "last_updated")


@query
def registry_after_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and customers added after a reset: only the customers are channels then."""
    from wirecount.sources import snapshots

    scratch = scratch_dir(spark)
    snapshots.publish_channels(inputs.channel_registry(spark, sf_dir), scratch, strict=False)
    snapshots.reset_channels(spark, scratch)
    snapshots.publish_channels(snapshots.load_registry(spark, scratch).unionByName(
        inputs.reader_registry(spark, sf_dir)), scratch, strict=False)
    return snapshots.load_registry(spark, scratch)


@query
def ml_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word pairs of the text stages as an ML pipeline."""
    from wirecount.functions.ml import text_pipeline

    heads = inputs.headlines(spark, sf_dir).select("title")
    fitted = text_pipeline("title", inputs.STOP_WORDS).fit(heads).transform(heads)
    # An outer generator: a plain one makes the optimizer repeat all stages in a filter.
    pairs = fitted.select(F.explode_outer("ngrams").alias("keyword")).where("keyword IS NOT NULL")
    return pairs.groupBy("keyword").agg(F.count("*").alias("count"))


@query
def entry_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = reg.read_entries(inputs.entries(spark, sf_dir))
    return read.where(F.col("reject_reason").isNotNull()).select(
        "channel_id", "title", "published", "reject_reason")


# Metrics, tables, series

@query
def metric_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = metrics.metric_rollup(inputs.samples(spark, sf_dir), tie=["event_id"])
    return rolled.select(
        "name", "kind", F.col("last_value").cast("double").alias("last_value"),
        F.round("total", 4).alias("total"), "shortest", F.round("mean", 6).alias("mean"),
        "longest", "members")


@query
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.events(spark, sf_dir).select("user_id", "event_type", "event_id", "value")
    incoming = rows.where("event_type = 'click'").withColumn("value", F.col("value") * 2)
    return tables.merged(rows, incoming, ["user_id", "event_type"], ["event_id"])


@query
def upsert_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days' counts in a bucketed table, upserted by the doubled counts of every second day."""
    from wirecount.sources import buckets

    daily = keywords_per(inputs.headlines(spark, sf_dir), "day", k=None, sizes=(1,))
    with _database(spark, scratch_dir(spark)):
        buckets.create(spark, "kept", "day", buckets=8)
        buckets.upsert(daily, "kept")
        again = daily.where(F.substr("day", F.lit(10), F.lit(1)).cast("int") % 2 == 0)
        buckets.upsert(again.withColumn("count", F.col("count") * 2), "kept")
        return _kept(spark.table("kept"))


@query
def two_batches_of_one_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in two batches of two streams that number them alike: an hour's counts are the
    sums of all its batches, equal ones included, and a replay adds nothing."""
    heads = inputs.headlines(spark, sf_dir)
    with _database(spark, scratch_dir(spark)):
        for run, odd in (("a", 0), ("b", 1), ("a", 0)):
            part = heads.where(F.col("doc_id") % 2 == odd)
            tables.write_batch_counts(
                keywords_per(part, "hour", k=None, sizes=(1,)), 0, run, in_order=True)
        hours = sorted({*tables.batch_hours(spark, 0, "a"), *tables.batch_hours(spark, 0, "b")})
        return _kept(tables.hour_counts(spark, hours))


@query
def compacted_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours from merged days: four batches of two streams, merged, one of them sent again and one
    more that is late, merged once more."""
    from wirecount.sources import compaction

    heads = inputs.headlines(spark, sf_dir)
    later = datetime(2100, 1, 1)
    with _database(spark, scratch_dir(spark)):
        def send(number, run):
            part = heads.where(F.col("doc_id") % 5 == number)
            tables.write_batch_counts(
                keywords_per(part, "hour", k=None, sizes=(1,)), number, run, in_order=True)

        for number in range(4):
            send(number, "a" if number < 2 else "b")
        compaction.compact(spark, later)
        send(1, "a")
        send(4, "b")
        compaction.compact(spark, later)
        send(3, "b")
        every = compaction.complete(spark, ALL_TIME[0].date(), ALL_TIME[1].date())
        return _kept(every.groupBy("hour", "keyword").agg(F.sum("count").alias("count")))


@query
def tops_after_deletion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored hourly tops less the labels of every third hour of the day."""
    with _database(spark, scratch_dir(spark)):
        tables.overwrite_labels(keywords_per(inputs.headlines(spark, sf_dir), "hour"),
                                "keywords_hour")
        gone = [h for h in tables.labels(spark, "keywords_hour") if int(h[-2:]) % 3 == 0]
        tables.delete_label(spark, "keywords_hour", *gone)
        return _kept(spark.table("keywords_hour"))


@query
def stored_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the rows of every stored label lie in its files from the highest count down."""
    with _database(spark, scratch_dir(spark)):
        tables.overwrite_labels(keywords_per(inputs.headlines(spark, sf_dir), "hour"),
                                "keywords_hour")
        rows = spark.table("keywords_hour").select(
            "hour", "keyword", "count", F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("at"))
        within = Window.partitionBy("hour", "file").orderBy("at")
        before = F.lag(F.struct((-F.col("count")).alias("c"), "keyword")).over(within)
        now = F.struct((-F.col("count")).alias("c"), "keyword")
        steps = rows.select("hour", (before.isNull() | (before < now)).alias("down"))
        return _kept(steps.groupBy("hour").agg(
            F.count("*").alias("n"), F.bool_and("down").alias("in_order")))


@query
def daily_from_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact top of every day, and whether the summaries of its hours hold each keyword of
    it, or say that they cannot, within bounds that hold its count."""
    from wirecount.operators import summaries

    hourly = keywords_per(inputs.headlines(spark, sf_dir), "hour", k=None)
    # Stored, as a job that has summaries does: what is merged from them reads them several times.
    short = _kept(summaries.summarized(hourly, "hour", 200))
    day = F.concat(F.substr("hour", F.lit(1), F.lit(10)), F.lit(" 00:00:00"))
    daily = summaries.merged(short, "hour", "day", day, 400)
    found = summaries.top(daily, "day").withColumnRenamed("day", "label")
    exact = keywords_per(inputs.headlines(spark, sf_dir), "day").withColumnRenamed("day", "label")
    says = found.groupBy("label").agg(F.bool_and("whole").alias("said_whole"))
    held = exact.join(found, ["label", "keyword"], "left").join(says, "label")
    return held.select(
        F.col("label").alias("day"), "keyword", "count",
        (F.col("low").isNotNull() | ~F.col("said_whole")).alias("held"),
        F.coalesce(F.col("count").between(F.col("low"), F.col("high")), F.lit(True))
        .alias("in_bounds"))


@query
def stored_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = keywords_per(inputs.headlines(spark, sf_dir), "hour", k=None)
    with _database(spark, scratch_dir(spark)):
        tables.write_batch_counts(hourly, 0, in_order=True)
        rollups.backfill(spark, "day", *ALL_TIME)
        rollups.backfill(spark, "month", *ALL_TIME, exact=False)
        return _kept(spark.table("keywords_month"))


@query
def daily_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = keywords_per(inputs.headlines(spark, sf_dir), "hour", k=None)
    with _database(spark, scratch_dir(spark)):
        tables.write_batch_counts(hourly, 0, in_order=True)
        rollups.backfill(spark, "day", *ALL_TIME)
        return _kept(spark.table("keywords_day"))


@query
def metric_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days merged from hourly sketches: what is exact, and whether the estimates keep to their
    error against all samples."""
    from wirecount.operators import sketches

    rows = inputs.events(spark, sf_dir).select(
        "ts", F.col("event_type").alias("name"), F.col("value").cast("string").alias("value"))
    daily = sketches.figures(sketches.merged(sketches.sketched(rows), "day"), [0.5])
    number = F.col("value").cast("double")
    exact = rows.groupBy(F.date_trunc("day", "ts").alias("period"), "name").agg(
        F.count_distinct("value").alias("all_members"), F.count("*").alias("all_n"),
        *(F.expr(f"percentile(CAST(value AS DOUBLE), {q})").alias(f"at{k}")
          for k, q in (("low", 0.45), ("high", 0.55))))
    # A day of few samples has quantiles far apart; half a sample either way is in the bounds.
    near = F.col("p50").between(F.col("atlow"), F.col("athigh")) | (F.col("all_n") < 40)
    error = F.abs(F.col("members") - F.col("all_members"))
    return daily.join(exact, ["period", "name"]).select(
        times.label(F.col("period"), "day").alias("day"), "name", "n",
        "shortest", "longest", F.round("total", 3).alias("total"),
        (error <= F.greatest(F.lit(1), F.ceil(0.04 * F.col("all_members")))).alias("members_near"),
        near.alias("median_near"))


@query
def metric_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of which some hold no number, and some nothing."""
    rows = _with_unread(spark, sf_dir)
    return metrics.counters(rows).withColumn("total", F.round("total", 4))


@query
def metric_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_unread(spark, sf_dir)
    return metrics.timings(rows).select("name", "shortest", F.round("mean", 6).alias("mean"),
                                        "longest", "unread")


def _with_unread(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = (F.when(F.col("event_id") % 7 == 0, "n/a").when(F.col("event_id") % 7 == 1, None)
             .otherwise(F.col("value").cast("string")))
    return inputs.events(spark, sf_dir).select(F.col("event_type").alias("name"),
                                               value.alias("value"))


@query
def series_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = series.series_range(inputs.events(spark, sf_dir), "event_type", "ts", "value", *RANGE,
                               ids=["click", "error"], extra=["user_id"])
    return rows.select("event_type", "value", micros("ts"), "user_id")


@query
def series_range_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = inputs.table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(
        "c_custkey")
    rows = series.series_range(inputs.events(spark, sf_dir), "user_id", "ts", "value", *RANGE,
                               ids=wanted)
    return rows.select("user_id", "value", micros("ts"))


@query
def panel_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs.events(spark, sf_dir).createOrReplaceTempView("panel_events")
    rows = series.panel_sql(
        spark,
        "SELECT event_type, count(*) AS n, max(value) AS highest FROM panel_events "
        "WHERE ts > $__timeFrom AND ts < $__timeTo "
        "AND unix_seconds(ts) > $__unixEpochFrom AND unix_seconds(ts) < $__unixEpochTo "
        "GROUP BY event_type", *RANGE)
    return rows


@query
def latest_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.events(spark, sf_dir).select("user_id", "ts", "event_id", "value", "event_type")
    return series.latest_per_series(rows, "user_id", "ts", ["event_id"]).withColumn(
        "ts", F.unix_micros("ts"))


@query
def newest_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.events(spark, sf_dir).select("event_id", "ts", "value")
    return series.newest_points(rows, "ts").withColumn("ts", F.unix_micros("ts"))


@query
def series_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points by the hour, so that a series has several at one time."""
    rows = inputs.events(spark, sf_dir).withColumn("ts", F.date_trunc("hour", "ts"))
    return series.wide(rows, "event_type", "ts", "value", EVENT_TYPES).withColumn(
        "ts", F.unix_micros("ts"))


@query
def series_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = series.with_labels(inputs.events(spark, sf_dir), "ts", "value",
                              ["user_id", "event_type"])
    pairs = F.transform(F.map_entries("labels"),
                        lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return rows.select(micros("ts"), "value", F.array_join(pairs, ",").alias("labels"))


@query
def series_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = series.with_alias(inputs.events(spark, sf_dir),
                             "{{ event_type }} of user {{user_id}} {{ missing }}")
    return rows.select("event_id", "alias")


def _bucketed(spark: SparkSession, sf_dir: str, unit: str) -> DataFrame:
    """Events in a table that is partitioned by the date a unit begins with."""
    folder = f"{scratch_dir(spark)}/rows"
    rows = inputs.events(spark, sf_dir).withColumn("date", F.trunc("ts", unit) if unit != "day"
                                                   else F.to_date("ts"))
    rows.hint("rebalance", "date").write.partitionBy("date").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


@query
def bucketed_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.bucket_range(_bucketed(spark, sf_dir, "day"), "date", "ts", *NIGHT).select(
        "user_id", micros("ts"), "value")


@query
def bucketed_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _bucketed(spark, sf_dir, "month")
    return series.bucket_range(rows, "date", "ts", *NIGHT, unit="month").select(
        "user_id", micros("ts"), "value")


@query
def epoch_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.events(spark, sf_dir).select(
        "event_id", F.unix_millis("ts").alias("ms"), F.unix_seconds("ts").alias("s"))
    inside = series.time_range(rows, "ms", *RANGE, epoch="ms")
    from_ms = times.from_epoch(F.col("ms"), "ms")
    from_s = times.from_epoch(F.col("s"), "s")
    return inside.select(
        "event_id", F.date_format(from_ms, "yyyy-MM-dd HH:mm:ss.SSS").alias("from_ms"),
        F.date_format(from_s, "yyyy-MM-dd HH:mm:ss").alias("from_s"))


@query
def variable_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.variable_values(inputs.events(spark, sf_dir), "event_type")


# Streams, run to the end of what is there

def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream, be it one file or a folder of files."""
    given = inputs.table(spark, sf_dir, name)
    # A pattern that the table's name alone matches: a plain path would have to be a folder.
    return spark.readStream.schema(given.schema).parquet(f"{sf_dir}/{name}.parque[t]")


@query
def stream_hourly_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wirecount.streaming.hourly import start_hourly

    scratch = scratch_dir(spark)
    heads = inputs.messages(inputs.shaped_headlines(_stream(spark, sf_dir, "documents")))
    sent = msg.to_messages(heads.withColumn("timestamp", F.col("published")))
    topic = sent.select("key", F.col("value").cast("binary").alias("value"),
                        F.lit(None).cast("timestamp").alias("timestamp"))
    with _database(spark, scratch) as database:
        start_hourly(topic, f"{scratch}/checkpoint", every=None,
                     label_from="published",
                     tasks=spark.sparkContext.defaultParallelism).awaitTermination()
        return _kept(spark.table(f"{database}.keywords_hour"))


@query
def stream_messages_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wirecount.streaming.updates import read_updates, start_updates
    from wirecount.streaming.windows import windowed_messages

    scratch = scratch_dir(spark)
    counted = windowed_messages(_stream(spark, sf_dir, "events"), ts="ts")
    start_updates(counted, f"{scratch}/rows", f"{scratch}/checkpoint",
                  every=None).awaitTermination()
    return read_updates(spark, f"{scratch}/rows", ["hour"])


@query
def stream_windowed_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop words and a dictionary as tables, the dictionary too big for a broadcast."""
    from wirecount.streaming.updates import read_updates, start_updates
    from wirecount.streaming.windows import windowed_keywords

    scratch = scratch_dir(spark)
    heads = inputs.shaped_headlines(_stream(spark, sf_dir, "documents"))
    counted = windowed_keywords(heads, stop_words=inputs.stop_words(spark),
                                lemmas=inputs.lemmas(spark, sf_dir), max_listed=0, max_bytes=0)
    start_updates(counted, f"{scratch}/rows", f"{scratch}/checkpoint",
                  every=None).awaitTermination()
    return read_updates(spark, f"{scratch}/rows", ["hour", "keyword"], grouped=True)


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wirecount.streaming.dedup import dedup_stream

    scratch = scratch_dir(spark)
    rows = _stream(spark, sf_dir, "events").withColumn("ts", times.as_instant(F.col("ts")))
    first = rows.withColumn("offset", F.col("event_id") * 2)
    again = rows.withColumn("offset", F.col("event_id") * 2 + 1)
    once = dedup_stream(first.unionByName(again), ts="ts", key="event_id",
                        spread_by=F.xxhash64("offset"), salts=4)
    (
        once.select("event_id", micros("ts"), "event_type", "value")
        .writeStream.format("parquet").option("path", f"{scratch}/rows")
        .option("checkpointLocation", f"{scratch}/checkpoint")
        .trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.parquet(f"{scratch}/rows")


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wirecount.plans.ingest import to_folder
    from wirecount.sources import snapshots
    from wirecount.streaming.ingest import start_ingest

    scratch = scratch_dir(spark)
    snapshots.publish_channels(inputs.reader_registry(spark, sf_dir), scratch, strict=False)
    rows = _stream(spark, sf_dir, "events")
    start_ingest(inputs.shaped_entries(rows), scratch, to_folder(f"{scratch}/messages"),
                 f"{scratch}/checkpoint", every=None).awaitTermination()
    return snapshots.load_registry(spark, scratch).select("id", "last_updated")


@query
def stream_topic_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream has noted of its source: messages held, and those it observed."""
    from wirecount.streaming import progress

    scratch = scratch_dir(spark)
    with _database(spark, scratch) as database:
        progress.create(spark)
        # Called for every report of the stream, as the session's listener is, but on this thread.
        listener = progress.ProgressListener(spark)
        seen = _stream(spark, sf_dir, "events").observe(
            "topic", F.count(F.lit(1)).alias("messages"))
        running = (
            seen.writeStream.format("noop").option("checkpointLocation", f"{scratch}/checkpoint")
            .trigger(availableNow=True).start())
        running.awaitTermination()
        for report in running.recentProgress:
            listener.keep(json.loads(report.json))
        noted = progress.topic_size(spark.table(f"{database}.{progress.OFFSETS}"))
        gauge = spark.table(f"{database}.{tables.METRICS}").where(
            F.col("name").endswith(".topic.messages"))
        observed = gauge.agg(F.sum(F.col("value").cast("long")).alias("observed"))
        return _kept(noted.withColumn("at", F.lit(0)).join(
            observed.withColumn("at", F.lit(0)), "at").select("messages", "observed"))


@query
def stream_marks_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marks of ``stream_ingest`` from keyed state instead of snapshots."""
    from wirecount.streaming import marks

    scratch = scratch_dir(spark)
    registry = inputs.reader_registry(spark, sf_dir)
    moved = marks.moved_marks(inputs.shaped_entries(_stream(spark, sf_dir, "events")), registry)
    (
        moved.writeStream.outputMode("update").option("checkpointLocation", f"{scratch}/checkpoint")
        .foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(
            f"{scratch}/moved/batch={number}"))
        .trigger(availableNow=True).start().awaitTermination()
    )
    kept = spark.read.parquet(f"{scratch}/moved")
    return marks.advanced(registry, kept).select("id", "last_updated")


@query
def stream_hourly_by_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly stream under a processing-time trigger and a clock that stands still."""
    from wirecount.streaming.hourly import start_hourly

    scratch = scratch_dir(spark)
    heads = inputs.messages(inputs.shaped_headlines(_stream(spark, sf_dir, "documents")))
    sent = msg.to_messages(heads.withColumn("timestamp", F.col("published")))
    topic = sent.select("key", F.col("value").cast("binary").alias("value"),
                        F.lit(None).cast("timestamp").alias("timestamp"))
    with _database(spark, scratch) as database:
        running = start_hourly(topic, f"{scratch}/checkpoint", every="1 second",
                               clock=lambda: datetime(2024, 3, 1, 12, 34),
                               tasks=spark.sparkContext.defaultParallelism)
        try:
            running.processAllAvailable()
        finally:
            running.stop()
        return _kept(spark.table(f"{database}.keywords_hour"))
