"""The registered queries in DuckDB SQL, written independently of the Spark side."""

from __future__ import annotations

from workload.inputs import STOP_WORDS, SUFFIX

HEADLINES = """headlines AS (
  SELECT doc_id, text AS title, source AS "ChannelTitle",
         TIMESTAMP '2024-01-27' + to_minutes(doc_id * 7919 % 14400) AS published
  FROM documents)"""

ISO = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"


def message_id(*parts: str) -> str:
    """Each part with its length before it, a null one as a dash."""
    return "sha256(" + " || ".join(
        f"coalesce(length({p}::VARCHAR) || ':' || ({p}), '-')" for p in parts) + ")"

MESSAGES = HEADLINES + f""", messages AS (
  SELECT {message_id('"ChannelTitle"', 'title', ISO.format('published'))} AS id,
         title, epoch_ms(published) AS published, "ChannelTitle"
  FROM headlines)"""

TOKENS = HEADLINES + r""", tokens AS (
  SELECT doc_id, published, regexp_extract_all(lower(title), '\p{L}+') AS t FROM headlines)"""

UNIGRAMS = "SELECT doc_id, published, unnest(t) AS keyword FROM tokens"
BIGRAMS = """SELECT doc_id, published, unnest(list_transform(
    range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS keyword FROM tokens"""
GRAMS = TOKENS + f", grams AS ({UNIGRAMS} UNION ALL {BIGRAMS})"

TOP = "row_number() OVER (PARTITION BY {} ORDER BY count DESC, keyword) <= 20"


def counts(shape: str, moment: str = "published") -> str:
    return f"""SELECT strftime({moment}, '{shape}') AS label, keyword,
        count(*)::BIGINT AS count FROM grams GROUP BY ALL"""


HOURLY = GRAMS + f""", hourly AS (
  SELECT label AS hour, keyword, count FROM ({counts('%Y-%m-%d %H')})
  QUALIFY {TOP.format('label')})"""

HOURLY_END = GRAMS + f""", hourly AS (
  SELECT label AS hour, keyword, count
  FROM ({counts('%Y-%m-%d %H', "published + INTERVAL 1 HOUR")})
  QUALIFY {TOP.format('label')})"""


def rolled(source: str, name: str, key: str) -> str:
    """Sums of ``source`` by an expression over its label, the top 20 of each."""
    return f"""SELECT {name}, keyword, count FROM (
        SELECT {key} AS {name}, keyword, sum(count)::BIGINT AS count
        FROM {source} GROUP BY ALL) WHERE {name} IS NOT NULL QUALIFY {TOP.format(name)}"""


DAILY = HOURLY + f", daily AS ({rolled('hourly', 'day', "hour[1:10] || ' 00:00:00'")})"

# The schedule spelled out run by run: every midnight, with its two text bounds.
SCHEDULED = HOURLY + f""", runs AS (
  SELECT strftime(d, '%Y-%m-%d 00:00:00') AS high,
         strftime(d - INTERVAL 1 DAY, '%Y-%m-%d 01:30:00') AS low
  FROM range(TIMESTAMP '2024-01-20', TIMESTAMP '2024-02-20', INTERVAL 1 DAY) AS r(d)),
picked AS (
  SELECT high, keyword, count FROM hourly JOIN runs ON hour >= low AND hour < high),
daily AS ({rolled('picked', 'day', 'high')})"""

LEMMAS = f"""words AS (
  SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS token FROM benchmark),
lemmas AS (
  SELECT token, regexp_replace(token, '{SUFFIX}', '') AS lemma FROM words
  WHERE regexp_replace(token, '{SUFFIX}', '') <> token
    AND length(regexp_replace(token, '{SUFFIX}', '')) >= 2)"""

STOPS = "stops(word) AS (VALUES " + ", ".join(f"('{w}')" for w in STOP_WORDS) + ")"

# Tokens by place, stop words out, lemmas in, then neighbours by a window.
CLEANED = TOKENS + f""", {STOPS}, {LEMMAS}, placed AS (
  SELECT doc_id, unnest(t) AS token, unnest(range(1, len(t) + 1)) AS pos FROM tokens),
kept AS (
  SELECT doc_id, pos, coalesce(lemma, token) AS w FROM placed LEFT JOIN lemmas USING (token)
  WHERE token NOT IN (SELECT word FROM stops)),
cleaned AS (
  SELECT doc_id, w AS keyword FROM kept
  UNION ALL
  SELECT doc_id, keyword FROM (
    SELECT doc_id, w || ' ' || lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS keyword FROM kept)
  WHERE keyword IS NOT NULL)"""

REGISTRY = """registry AS (
  SELECT s_suppkey + 1 AS id, s_name AS title, 'u' || s_suppkey AS url,
         s_suppkey * 1000 AS last_updated FROM supplier)"""

READERS = """readers AS (
  SELECT c_custkey AS id, c_name AS title, 'u' || c_custkey AS url,
         CASE WHEN c_nationkey <> 0
              THEN 1704067200000 + c_nationkey::BIGINT * 86400000 END AS last_updated
  FROM customer)"""

ENTRIES = READERS + """, entries AS (
  SELECT event_id, user_id AS channel_id, date_trunc('second', ts) AS ts, event_id % 11 AS kind,
         CASE WHEN event_id % 13 <> 0 THEN event_type || ' ' || props END AS title
  FROM events WHERE event_id % 11 <> 1),
fresh AS (
  SELECT channel_id, e.title, epoch_ms(ts) AS published, r.title AS "ChannelTitle", ts
  FROM entries e JOIN readers r ON r.id = channel_id
  WHERE kind <> 0 AND e.title IS NOT NULL AND epoch_ms(ts) > coalesce(last_updated, 0)),
advanced AS (
  SELECT id, title, url, CASE WHEN latest IS NULL THEN last_updated
         ELSE greatest(coalesce(last_updated, 0), latest) END AS last_updated
  FROM readers LEFT JOIN (
    SELECT channel_id, max(published) AS latest FROM fresh GROUP BY 1) ON channel_id = id)"""

RANGE = "ts > TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-20 18:00:00'"

KINDS = "['gauge', 'counter', 'timing', 'set']"

SQL: dict[str, str] = {
    "tokenize": r"""
        SELECT doc_id, len(t)::BIGINT AS n_tokens, array_to_string(t, ' ') AS tokens
        FROM (SELECT doc_id, regexp_extract_all(lower(text), '\p{L}+') AS t FROM documents)""",
    "tokenize_clean": r"""
        SELECT doc_id, len(t)::BIGINT AS n_tokens, array_to_string(t, ' ') AS tokens
        FROM (SELECT doc_id, list_filter(list_transform(
                  string_split_regex(lower(text), '[ \t\n\x0B\f\r]+'),
                  lambda w: regexp_replace(w, '[^\p{L}+]', '', 'g')), lambda w: w <> '') AS t
              FROM documents)""",
    "trigrams": f"""WITH {TOKENS}
        SELECT keyword, count(*)::BIGINT AS count FROM (
          SELECT unnest(list_transform(range(1, len(t) - 1),
                 lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) AS keyword FROM tokens)
        GROUP BY 1""",
    "stopword_anti": f"""WITH {TOKENS}, {STOPS}
        SELECT token, count(*)::BIGINT AS count FROM (SELECT unnest(t) AS token FROM tokens)
        WHERE token NOT IN (SELECT word FROM stops) GROUP BY 1""",
    "lemma_lookup": f"""WITH {TOKENS}, {LEMMAS}
        SELECT coalesce(lemma, token) AS lemma, count(*)::BIGINT AS count
        FROM (SELECT unnest(t) AS token FROM tokens) LEFT JOIN lemmas USING (token) GROUP BY 1""",
    "unigram_counts": f"""WITH {TOKENS}
        SELECT keyword, count(*)::BIGINT AS count FROM ({UNIGRAMS}) GROUP BY 1""",
    "bigram_counts": f"""WITH {TOKENS}
        SELECT keyword, count(*)::BIGINT AS count FROM ({BIGRAMS}) GROUP BY 1""",
    "keyword_counts": f"""WITH {GRAMS}
        SELECT keyword, count(*)::BIGINT AS count FROM grams GROUP BY 1""",
    "keyword_counts_cleaned": f"""WITH {CLEANED}
        SELECT keyword, count(*)::BIGINT AS count FROM cleaned GROUP BY 1""",
    "keyword_counts_cleaned_by_shuffle": f"""WITH {CLEANED}
        SELECT keyword, count(*)::BIGINT AS count FROM cleaned GROUP BY 1""",
    "keyword_counts_distinct_titles": f"""WITH {TOKENS.replace('FROM headlines)',
        'FROM (SELECT title, min(doc_id) AS doc_id, min(published) AS published '
        'FROM headlines GROUP BY title))')}, grams AS ({UNIGRAMS} UNION ALL {BIGRAMS})
        SELECT keyword, count(*)::BIGINT AS count FROM grams GROUP BY 1""",
    "keyword_top20": f"""WITH {GRAMS}
        SELECT keyword, count(*)::BIGINT AS count FROM grams GROUP BY 1
        ORDER BY count DESC, keyword LIMIT 20""",
    "hour_label": f"""WITH {HEADLINES}
        SELECT doc_id, strftime(published, '%Y-%m-%d %H') AS hour,
               strftime(published + INTERVAL 1 HOUR, '%Y-%m-%d %H') AS hour_end,
               strftime(published, '%Y-%m-%d 00:00:00') AS day,
               strftime(date_trunc('month', published) + INTERVAL 1 MONTH, '%Y-%m') AS month_end
        FROM headlines""",
    "hourly_top20": f"WITH {HOURLY} SELECT hour, keyword, count FROM hourly",
    "latest_hour_top20": f"""WITH {HOURLY}
        SELECT hour, keyword, count FROM hourly WHERE hour = (SELECT max(hour) FROM hourly)""",
    "daily_rollup": f"WITH {DAILY} SELECT day, keyword, count FROM daily",
    "monthly_rollup": f"WITH {DAILY} {rolled('daily', 'month', 'day[1:7]')}",
    "daily_rollup_end_labels": f"""WITH {HOURLY_END} {rolled('hourly', 'day',
        "strftime(strptime(hour, '%Y-%m-%d %H') - INTERVAL 1 HOUR + INTERVAL 1 DAY, "
        "'%Y-%m-%d 00:00:00')")}""",
    "daily_rollup_one_day": f"""WITH {DAILY}
        SELECT day, keyword, count FROM daily WHERE day = '2024-01-31 00:00:00'""",
    "daily_rollup_scheduled": f"WITH {SCHEDULED} SELECT day, keyword, count FROM daily",
    "monthly_rollup_scheduled": f"""WITH {SCHEDULED}, months AS (
          SELECT m AS low, CASE m WHEN '2024-01' THEN '2024-02' ELSE '2024-03' END AS high
          FROM (VALUES ('2024-01'), ('2024-02')) v(m)),
        taken AS (SELECT low, keyword, count FROM daily JOIN months ON day >= low AND day < high)
        {rolled('taken', 'month', 'low')}""",
    "monthly_exact": f"""WITH {GRAMS}
        SELECT label AS month, keyword, count FROM ({counts('%Y-%m')})
        QUALIFY {TOP.format('label')}""",
    "label_range_scan": f"""WITH {HOURLY} SELECT hour, keyword, count FROM hourly
        WHERE hour >= '2024-01-28 01:30:00' AND hour < '2024-01-31 00:00:00'""",
    "label_calendar": """
        WITH days AS (SELECT DISTINCT date_trunc('day', ts) AS d FROM events)
        SELECT strftime(d, '%Y-%m-%d 01:30:00') AS as_of,
               strftime(d, '%Y-%m-%d 00:00:00') AS today,
               strftime(d - INTERVAL 1 DAY, '%Y-%m-%d 01:30:00') AS yesterday,
               strftime(d, '%Y-%m') AS month,
               strftime(date_trunc('month', d) - INTERVAL 1 DAY, '%Y-%m') AS previous_month,
               strftime(date_trunc('month', d) + INTERVAL 32 DAY, '%Y-%m') AS next_month,
               day(d) = 1 AS first_of_month
        FROM days""",
    "json_parse": """
        SELECT 'e' || event_id AS key, event_id::VARCHAR AS id, event_type AS title,
               epoch_ms(date_trunc('second', ts)) AS published, props AS "ChannelTitle",
               NULL::VARCHAR AS reject_reason FROM events
        UNION ALL
        SELECT 'd' || doc_id, NULL, NULL, NULL, NULL, 'malformed' FROM documents""",
    "message_json": f"""WITH {MESSAGES}
        SELECT id AS key, 'feeds' AS topic, id, title, published, "ChannelTitle" FROM messages""",
    "published_parse": """
        WITH moments AS (SELECT event_id, date_trunc('second', ts) AS ts FROM events),
        each AS (SELECT event_id, ts, unnest(['iso', 'iso_offset', 'iso_bare', 'mail',
                 'mail_offset', 'mail_zone', 'year']) AS form FROM moments),
        judged AS (SELECT *, form NOT IN ('mail_zone', 'year') AS good,
                   CASE WHEN form LIKE '%offset' THEN ts + INTERVAL 2 HOUR ELSE ts END AS wall_ts
                   FROM each)
        SELECT event_id, form, CASE WHEN good THEN epoch_ms(ts) END AS epoch_ms,
               CASE WHEN good THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS iso,
               CASE WHEN good THEN strftime(wall_ts, '%Y-%m-%dT%H:%M:%SZ') END AS wall
        FROM judged""",
    "blank_default": """
        SELECT event_id, CASE event_id % 7 WHEN 0 THEN 0 WHEN 2 THEN NULL ELSE user_id END
               AS last_updated FROM events""",
    "message_dedup": f"""WITH {MESSAGES}
        SELECT DISTINCT id, title, published, "ChannelTitle" FROM messages""",
    "titles_per_channel": f"""WITH {HEADLINES}, counted AS (
          SELECT "ChannelTitle", title, count(*) AS n,
                 ('0x' || md5(title)[1:8])::BIGINT AS h FROM headlines GROUP BY ALL),
        sized AS (SELECT *, count(*) OVER (PARTITION BY "ChannelTitle") AS m FROM counted)
        SELECT "ChannelTitle",
               CASE WHEN m > 25 THEN h % ceil(m / 25.0)::BIGINT ELSE 0 END AS chunk,
               count(*)::BIGINT AS n_titles,
               string_agg(title || ' x ' || n, chr(10) ORDER BY title) AS titles
        FROM sized GROUP BY 1, 2""",
    "topic_size": """
        SELECT sum(held)::BIGINT AS messages FROM (
          SELECT max(event_id // 3) - min(event_id // 3) + 1 AS held
          FROM events GROUP BY event_id % 3)""",
    "messages_per_hour": """
        SELECT strftime(ts, '%Y-%m-%d %H') AS hour, count(*)::BIGINT AS messages
        FROM events GROUP BY 1""",
    "ttl_filter": """
        SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, value FROM events
        WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 172800 SECOND""",
    "retained_messages": """
        SELECT sum(held)::BIGINT AS messages FROM (
          SELECT max(event_id // 3) - min(event_id // 3) + 1 AS held FROM events
          WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOUR GROUP BY event_id % 3)""",
    "registry_scan": f"WITH {REGISTRY} SELECT id, title, url, last_updated FROM registry",
    "channel_totals": f"WITH {REGISTRY} SELECT count(*)::BIGINT AS channels FROM registry",
    "channel_insert": f"""WITH {REGISTRY}, candidates AS (
          SELECT c_custkey AS position, c_name AS title, 'u' || (c_custkey % 1000) AS url
          FROM customer QUALIFY row_number() OVER (PARTITION BY url ORDER BY c_custkey) = 1),
        absent AS (SELECT * FROM candidates WHERE url NOT IN (SELECT url FROM registry))
        SELECT id, title, url, last_updated FROM registry
        UNION ALL
        SELECT (SELECT max(id) FROM registry) + row_number() OVER (ORDER BY position),
               title, url, 0 FROM absent""",
    "channel_file": """
        SELECT 'say, "' || c_name || '"' || chr(10) || 'again' AS title, 'u' || (c_custkey % 1000) AS url,
               CASE c_custkey % 5 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE c_custkey END
               AS last_updated,
               CASE c_custkey % 5 WHEN 1 THEN 'mark is no number' END AS reject_reason
        FROM customer""",
    "registry_faults": """
        WITH rows AS (SELECT c_custkey AS id, 'u' || (c_custkey % 1000) AS url FROM customer)
        SELECT id, url, 'last_updated missing' AS fault FROM rows
        UNION ALL
        SELECT NULL, url, 'url repeated' FROM rows GROUP BY url HAVING count(*) > 1""",
    "incremental_new": f"""WITH {ENTRIES}
        SELECT {message_id('channel_id::VARCHAR', 'title', ISO.format('ts'))} AS id,
               title, published, "ChannelTitle" FROM fresh""",
    "incremental_new_by_shuffle": f"""WITH {ENTRIES}
        SELECT {message_id('channel_id::VARCHAR', 'title', ISO.format('ts'))} AS id,
               title, published, "ChannelTitle" FROM fresh""",
    "new_message_count": f"""WITH {ENTRIES}
        SELECT count(*)::BIGINT AS new_messages FROM fresh""",
    "registry_advance": f"""WITH {ENTRIES}
        SELECT id, title, url, last_updated FROM advanced""",
    "entry_rejects": f"""WITH {ENTRIES}
        SELECT channel_id, title,
          CASE kind WHEN 0 THEN strftime(ts, '%a, %d %b %Y %H:%M:%S EST')
                    WHEN 2 THEN strftime(ts, '%a, %d %b %Y %H:%M:%S GMT')
                    WHEN 3 THEN strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S+02:00')
                    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS published,
          CASE WHEN kind = 0 THEN 'unreadable date' ELSE 'no title' END AS reject_reason
        FROM entries WHERE kind = 0 OR title IS NULL""",
    "metric_rollup": f"""
        WITH samples AS (SELECT ts, event_id, event_type AS name,
                         {KINDS}[user_id % 4 + 1] AS kind, value FROM events)
        SELECT name, kind, arg_max(value, event_id) AS last_value,
               CASE WHEN kind = 'counter' THEN round(sum(value), 4) END AS total,
               CASE WHEN kind = 'timing' THEN min(value) END AS shortest,
               CASE WHEN kind = 'timing' THEN round(avg(value), 6) END AS mean,
               CASE WHEN kind = 'timing' THEN max(value) END AS longest,
               CASE WHEN kind = 'set' THEN count(DISTINCT value) ELSE 0 END AS members
        FROM samples GROUP BY name, kind""",
    "upsert_latest": """
        WITH both_sides AS (
          SELECT user_id, event_type, event_id, value, 0 AS incoming FROM events
          UNION ALL
          SELECT user_id, event_type, event_id, value * 2, 1 FROM events
          WHERE event_type = 'click')
        SELECT user_id, event_type, event_id, value FROM both_sides
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type
                                   ORDER BY incoming DESC, event_id DESC) = 1""",
    "two_batches_of_one_hour": f"""WITH {TOKENS}
        SELECT strftime(published, '%Y-%m-%d %H') AS hour, keyword, count(*)::BIGINT AS count
        FROM ({UNIGRAMS}) GROUP BY 1, 2""",
    "daily_exact": f"""WITH {GRAMS}
        SELECT label AS day, keyword, count FROM ({counts('%Y-%m-%d 00:00:00')})
        QUALIFY {TOP.format('label')}""",
    "upsert_in_buckets": f"""WITH {TOKENS}
        SELECT keyword, (count(*) * CASE day(published) % 2 WHEN 0 THEN 2 ELSE 1 END)::BIGINT AS count,
               strftime(published, '%Y-%m-%d 00:00:00') AS day
        FROM ({UNIGRAMS}) GROUP BY keyword, day(published), 3""",
    "compacted_hours": f"""WITH {TOKENS}
        SELECT strftime(published, '%Y-%m-%d %H') AS hour, keyword, count(*)::BIGINT AS count
        FROM ({UNIGRAMS}) GROUP BY 1, 2""",
    "tops_after_deletion": f"""WITH {HOURLY} SELECT keyword, count, hour FROM hourly
        WHERE hour[12:13]::INT % 3 != 0""",
    "stored_order": f"""WITH {HOURLY}
        SELECT hour, count(*) AS n, true AS in_order FROM hourly GROUP BY 1""",
    "stream_hourly_by_clock": f"""WITH {GRAMS}
        SELECT keyword, count(*)::BIGINT AS count, '2024-03-01 12' AS hour FROM grams
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "daily_from_summaries": f"""WITH {GRAMS}
        SELECT label AS day, keyword, count, true AS held, true AS in_bounds
        FROM ({counts('%Y-%m-%d 00:00:00')}) QUALIFY {TOP.format('label')}""",
    "entries_at_the_mark": f"""WITH {ENTRIES}, good AS (
          SELECT e.channel_id, epoch_ms(e.ts) AS ms FROM entries e
          JOIN customer ON c_custkey = channel_id WHERE e.kind > 1 AND e.title IS NOT NULL
        ), ranked AS (
          SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY ms) AS r,
                 count(*) OVER (PARTITION BY channel_id) AS n FROM good
        ), marked AS (
          SELECT *, max(CASE WHEN r = ceil(n / 2) THEN ms END) OVER (PARTITION BY channel_id) AS m
          FROM ranked
        ) SELECT channel_id, count(*) FILTER (ms >= m) AS from_mark,
                 count(*) FILTER (ms > m) AS after_mark FROM marked GROUP BY channel_id""",
    "landed_documents": f"WITH {ENTRIES} SELECT id, last_updated FROM advanced",
    "registry_after_reset": """
        SELECT c_custkey AS id, c_name AS title, 'u' || c_custkey AS url,
               CASE WHEN c_nationkey != 0 THEN 1704067200000 + c_nationkey * 86400000 END
                 AS last_updated FROM customer""",
    "ml_bigrams": f"""
        WITH {HEADLINES}, words AS (
          SELECT list_filter(regexp_extract_all(lower(title), '\\p{{L}}+'),
                             lambda w: w NOT IN ({', '.join(repr(w) for w in STOP_WORDS)})) AS t
          FROM headlines)
        SELECT keyword, count(*)::BIGINT AS count FROM (SELECT unnest(list_transform(
          range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS keyword FROM words)
        GROUP BY 1""",
    "stream_topic_size": """
        SELECT count(*)::BIGINT AS messages, count(*)::BIGINT AS observed FROM events""",
    "metric_sketches": """
        SELECT strftime(ts, '%Y-%m-%d 00:00:00') AS day, event_type AS name, count(*) AS n,
               min(value) AS shortest, max(value) AS longest, round(sum(value), 3) AS total,
               true AS members_near, true AS median_near
        FROM events GROUP BY 1, 2""",
    "metric_counters": """
        SELECT event_type AS name,
               round(sum(CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE value END), 4)
                 AS total,
               count(*) FILTER (event_id % 7 = 0) AS unread
        FROM events GROUP BY 1""",
    "metric_timings": """
        SELECT event_type AS name, min(value) FILTER (event_id % 7 > 1) AS shortest,
               round(avg(value) FILTER (event_id % 7 > 1), 6) AS mean,
               max(value) FILTER (event_id % 7 > 1) AS longest,
               count(*) FILTER (event_id % 7 = 0) AS unread
        FROM events GROUP BY 1""",
    "bucketed_by_month": """
        SELECT user_id, epoch_us(ts) AS ts, value FROM events
        WHERE ts > TIMESTAMP '2024-01-09 22:00:00' AND ts < TIMESTAMP '2024-01-11 03:00:00'""",
    "stream_windowed_keywords": f"""WITH {CLEANED}
        SELECT strftime(published, '%Y-%m-%d %H') AS hour, keyword, count(*)::BIGINT AS count
        FROM cleaned JOIN headlines USING (doc_id) GROUP BY 1, 2""",
    "stored_rollup": f"""WITH {GRAMS}, daily AS (
          SELECT label AS day, keyword, count FROM ({counts('%Y-%m-%d 00:00:00')})
          QUALIFY {TOP.format('label')})
        {rolled('daily', 'month', 'day[1:7]')}""",
    "series_range": f"""
        SELECT event_type, value, epoch_us(ts) AS ts, user_id FROM events
        WHERE event_type IN ('click', 'error') AND {RANGE}""",
    "series_range_listed": f"""
        SELECT user_id, value, epoch_us(ts) AS ts FROM events
        WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
          AND {RANGE}""",
    "panel_query": """
        SELECT event_type, count(*)::BIGINT AS n, max(value) AS highest FROM events
        WHERE ts >= TIMESTAMP '2024-01-05 06:00:01' AND ts < TIMESTAMP '2024-01-20 18:00:00'
        GROUP BY 1""",
    "latest_per_series": """
        SELECT user_id, epoch_us(ts) AS ts, event_id, value, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "newest_point": """
        SELECT event_id, epoch_us(ts) AS ts, value FROM events
        WHERE ts = (SELECT max(ts) FROM events)""",
    "series_wide": """
        SELECT epoch_us(date_trunc('hour', ts)) AS ts,
               max(value) FILTER (event_type = 'click') AS click,
               max(value) FILTER (event_type = 'error') AS error,
               max(value) FILTER (event_type = 'purchase') AS purchase,
               max(value) FILTER (event_type = 'signup') AS signup,
               max(value) FILTER (event_type = 'view') AS "view"
        FROM events GROUP BY 1""",
    "series_labels": """
        SELECT epoch_us(ts) AS ts, value,
               'event_type=' || event_type || ',user_id=' || user_id AS labels FROM events""",
    "series_alias": """
        SELECT event_id, event_type || ' of user ' || user_id || ' {{ missing }}' AS alias
        FROM events""",
    "bucketed_range": """
        SELECT user_id, epoch_us(ts) AS ts, value FROM events
        WHERE ts > TIMESTAMP '2024-01-09 22:00:00' AND ts < TIMESTAMP '2024-01-11 03:00:00'""",
    "epoch_to_ts": """
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS from_ms,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS from_s FROM events
        WHERE epoch_ms(ts) > epoch_ms(TIMESTAMP '2024-01-05 06:00:00')
          AND epoch_ms(ts) < epoch_ms(TIMESTAMP '2024-01-20 18:00:00')""",
    "variable_values": "SELECT DISTINCT event_type FROM events",
    "stream_messages_per_hour": """
        SELECT strftime(ts, '%Y-%m-%d %H') AS hour, count(*)::BIGINT AS messages
        FROM events GROUP BY 1""",
    "stream_hourly_top20": f"WITH {HOURLY} SELECT hour, keyword, count FROM hourly",
    "stream_dedup": "SELECT event_id, epoch_us(ts) AS ts, event_type, value FROM events",
    "stream_marks_by_state": f"WITH {ENTRIES} SELECT id, last_updated FROM advanced",
    "stream_ingest": f"WITH {ENTRIES} SELECT id, last_updated FROM advanced",
}
