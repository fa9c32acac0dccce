"""Headlines to keyword counts, and the top of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType

from wirecount.functions import text
from wirecount.functions.listed import Listed, Sieve
from wirecount.operators.lookup import MAX_BROADCAST_BYTES, fits_broadcast, lookup_join
from wirecount.session import shared_dir

#: Stop words of a table that are listed as they are; of more, only those that titles hold.
MAX_LISTED_WORDS = 10_000
#: Words in one literal, and of a table in a stream, which cannot be looked through beforehand.
LITERAL_WORDS = 1_000_000
#: Text of one group whose words a task counts alone.
GROUP_BYTES = 64 << 20
TOP = 20


def english_stop_words() -> list[str]:
    """Spark's own English list, for users without one; needs a running session."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords("english")


def one_title_per_row(df: DataFrame, title: str = "title") -> DataFrame:
    """Null titles go; a column of title arrays becomes one row per title."""
    if isinstance(df.schema[title].dataType, ArrayType):
        df = df.withColumn(title, F.explode(title))
    return df.where(F.col(title).isNotNull())


def _word(stop_words: DataFrame) -> DataFrame:
    word = F.lower(F.col(stop_words.columns[0]))
    return stop_words.select(word.alias("word")).where("word != ''").distinct()


def _at_most(words: DataFrame, most: int) -> list[str] | None:
    """The words, or None where they are more."""
    rows = words.limit(most + 1).collect()
    return None if len(rows) > most else [r["word"] for r in rows]


def _occurring(tokens: DataFrame, words: DataFrame, max_bytes: int) -> list[list[str]]:
    """Those of ``words`` that are among the distinct tokens, in lists of bounded size.

    Tokens that cannot be listed are dropped where they stand, before any is grouped.
    """
    shared_dir(tokens.sparkSession)
    sieve = Sieve(words)
    # An outer generator: a plain one makes the optimizer repeat the tokenizer in a filter.
    vocabulary = (
        tokens.select(F.explode_outer("tokens").alias("word"))
        .where(F.col("word").isNotNull() & sieve.lets(F.col("word"))).distinct()
    )
    held = lookup_join(vocabulary, words, ["word"], "left_semi", max_bytes=max_bytes).checkpoint()
    parts = -(-held.count() // LITERAL_WORDS)
    number = F.pmod(F.crc32("word"), F.lit(parts))
    return [[r["word"] for r in held.where(number == i).collect()] for i in range(parts)]


def tokenized(df: DataFrame, title: str = "title", mode: str = "letters",
              stop_words: Sequence[str] | DataFrame | None = None,
              row_id: Sequence[str] = (), max_listed: int = MAX_LISTED_WORDS,
              max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` with ``title`` replaced by ``tokens array<string>``, stop words removed.

    A title of stop words only keeps an empty array. Stop words are a literal inside the scan
    stage, so tokens are dropped where they stand and no title is taken apart. Of a table longer
    than ``max_listed`` only the words that occur in the titles go into it: the distinct tokens
    meet the table first. In a stream that cannot be known, so there the table is listed whole,
    and one of more than ``LITERAL_WORDS`` is refused; the hourly stream, whose batches are
    tables, takes any. ``row_id`` has no effect any more.
    """
    words = one_title_per_row(df, title).withColumn("tokens", text.tokens(F.col(title), mode))
    words = words.drop(title)
    if stop_words is None:
        return words
    if not isinstance(stop_words, DataFrame):
        return words.withColumn("tokens", text.without(F.col("tokens"), list(stop_words)))
    listed = _at_most(_word(stop_words), max_listed)
    if listed is not None:
        return words.withColumn("tokens", text.without(F.col("tokens"), listed))
    if df.isStreaming:
        lists = [_at_most(_word(stop_words), LITERAL_WORDS)]
        if lists[0] is None:
            raise ValueError(f"a stream takes at most {LITERAL_WORDS} stop words; use the hourly "
                             "stream, whose batches take any number")
    else:
        lists = _occurring(words.select("tokens"), _word(stop_words), max_bytes)
    for part in lists:
        words = words.withColumn("tokens", _without(F.col("tokens"), part))
    return words


def _without(tokens: Column, words: list[str]) -> Column:
    if len(words) <= MAX_LISTED_WORDS:
        return text.without(tokens, words)
    listed = Listed(words)
    return F.filter(tokens, lambda t: ~listed.has(t))


def stop_rows(token_rows: DataFrame, stop_words: DataFrame, token: str = "token") -> DataFrame:
    """Rows whose token is not listed, case-insensitively (anti join)."""
    stop = stop_words.select(F.lower(F.col(stop_words.columns[0])).alias(token)).distinct()
    return lookup_join(token_rows, stop, [token], "left_anti", spread_by=token_rows.columns)


def token_rows(df: DataFrame, keep: Sequence[str] = (), title: str = "title",
               mode: str = "letters") -> DataFrame:
    """One row per token: ``keep`` columns and ``token``."""
    return (
        tokenized(df.select(*keep, title), title, mode)
        .select(*keep, F.explode_outer("tokens").alias("token"))
        .where(F.col("token").isNotNull())
    )


def lemma_table(lemmas: DataFrame) -> DataFrame:
    """A dictionary with one lemma per lower-case token."""
    token, lemma = lemmas.columns[:2]
    return (
        lemmas.where(F.col(token).isNotNull())
        .groupBy(F.lower(F.col(token)).alias("token"))
        .agg(F.min(lemma).alias("lemma"))
    )


def lemma_counts(counted: DataFrame, lemmas: DataFrame, token: str = "token") -> DataFrame:
    """``(token, count)`` rows as ``(lemma, count)``; unknown tokens stay as they are.

    Meant for counts rather than single tokens: looking up what is already grouped
    sends no hot word through the join more than once per group.
    """
    known = lemma_table(lemmas).withColumnRenamed("token", token)
    return (
        lookup_join(counted, known, [token], "left", spread_by=counted.columns)
        .groupBy(F.coalesce("lemma", token).alias("lemma"))
        .agg(F.sum("count").alias("count"))
    )


def keyword_counts(titles: DataFrame, by: Sequence[str] = (), title: str = "title",
                   sizes: Sequence[int] = (1, 2), mode: str = "letters",
                   stop_words: Sequence[str] | DataFrame | None = None,
                   lemmas: DataFrame | None = None,
                   row_id: Sequence[str] = (), dedupe_titles: bool = False,
                   max_listed: int = MAX_LISTED_WORDS,
                   max_bytes: int = MAX_BROADCAST_BYTES,
                   among: DataFrame | None = None) -> DataFrame:
    """Count the n-grams of every title: ``by`` columns, ``keyword``, ``count``.

    Unigrams and bigrams (``sizes``) come from one pass over the titles and one
    aggregation, combined on the map side, so a word found everywhere costs one row
    per task. An n-gram never crosses from one title into the next. A title that comes
    up again, say on another channel, counts again unless ``dedupe_titles``. Beyond
    ``max_listed`` stop words the distinct tokens meet the table first, beyond ``max_bytes`` of
    lemmas the dictionary is joined by shuffle. In a stream a dictionary of up to
    ``LITERAL_WORDS`` entries is looked up in place. With ``among``, a table of ``by`` columns and
    ``_word`` that fits a broadcast, only n-grams of these words are counted.
    """
    if dedupe_titles:
        titles = titles.dropDuplicates([*by, title])
    needed = list(dict.fromkeys([*by, *row_id, title]))
    words = tokenized(titles.select(*needed), title, mode, stop_words, row_id, max_listed,
                      max_bytes)
    words = words.select(*by, "tokens")
    if lemmas is not None and words.isStreaming:
        known = _dictionary(lemmas)
        if known is not None:
            words = words.withColumn("tokens", F.transform("tokens", known.value))
            lemmas = None
    places = [f"_w{k}" for k in range(1, max(sizes) + 1)]
    rows = _with_following(words, by, places)
    plain = None
    if lemmas is not None:
        rows, plain = _lemmatized(rows, by, places, lemmas, max_bytes)
    if among is not None:
        rows = _of_words(rows, by, places[:min(sizes)], among)
        plain = plain and _of_words(plain, by, places[:min(sizes)], among)
    grouped = "_times" in rows.columns
    grams = [_joined(places[:n]) for n in sizes]
    each = _each_gram(rows, [*by, "_times"] if grouped else by, grams)
    if plain is not None:
        each = each.unionByName(
            _each_gram(plain, by, grams).withColumn("_times", F.lit(1).cast("long")))
    return (
        each.groupBy(*by, "keyword")
        .agg((F.sum("_times") if grouped else F.count("*")).alias("count"))
    )


def _dictionary(lemmas: DataFrame) -> Listed | None:
    """The lemmas as a literal, or None where there are too many or one cannot stand in it."""
    known = lemma_table(lemmas).where("lemma IS NOT NULL")
    rows = known.limit(LITERAL_WORDS + 1).collect()
    if len(rows) > LITERAL_WORDS:
        return None
    try:
        return Listed({r["token"]: r["lemma"] for r in rows})
    except ValueError:
        return None


def _with_following(words: DataFrame, by: Sequence[str], places: Sequence[str]) -> DataFrame:
    """One row per token, with the tokens that follow it in its title beside it."""
    t = F.col("tokens")
    shifted = words.select(
        *by, *(text.following(t, k).alias(c) if k > 1 else t.alias(c)
               for k, c in enumerate(places, 1)))
    # An outer generator: a plain one makes the optimizer repeat the tokenizer in a filter.
    return (
        shifted.select(*by, F.inline_outer(F.arrays_zip(*places)))
        .where(F.col(places[0]).isNotNull())
    )


def _each_gram(rows: DataFrame, keep: Sequence[str], grams: Sequence[Column]) -> DataFrame:
    """A row per n-gram; one that would reach past the title's end is null and dropped."""
    each = grams[0] if len(grams) == 1 else F.explode_outer(F.array(*grams))
    return rows.select(*keep, each.alias("keyword")).where(F.col("keyword").isNotNull())


def _lemmatized(rows: DataFrame, by: Sequence[str], places: Sequence[str],
                lemmas: DataFrame, max_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """The same rows over lemmas, grouped with their number ``_times`` where that pays.

    A lemma depends on its token alone, so every token is looked up where it stands and
    titles are not taken apart and put together again. A dictionary too big to broadcast
    meets the already grouped rows instead of every occurrence, and of these only rows with a
    token it may have. All other rows are the second result; the titles are read again for them.
    """
    known = lemma_table(lemmas)
    small = fits_broadcast(known, max_bytes)
    plain = None
    # A stream can be aggregated once only, so there every occurrence meets the dictionary.
    if not small and not rows.isStreaming:
        sieve = Sieve(known.select("token"))
        may = reduce(or_, (F.col(c).isNotNull() & sieve.lets(F.col(c)) for c in places))
        plain, rows = rows.where(~may), rows.where(may)
        rows = rows.groupBy(*by, *places).agg(F.count("*").alias("_times"))
    for place in places:
        entry = known.select(F.col("token").alias(place), F.col("lemma").alias("_lemma"))
        rows = (
            lookup_join(rows, entry, [place], "left", spread_by=[*by, *places], small=small)
            .withColumn(place, F.coalesce("_lemma", place)).drop("_lemma")
        )
    return rows, plain


def _of_words(rows: DataFrame, by: Sequence[str], places: Sequence[str],
              among: DataFrame) -> DataFrame:
    """Rows whose tokens at ``places`` are all listed; looked up where they stand.

    Groups without a name are groups too.
    """
    for at, place in enumerate(places):
        names = [f"_{at}_{c}" for c in by]
        listed = F.broadcast(among.select(
            *(F.col(c).alias(n) for c, n in zip(by, names)), F.col("_word").alias(f"_{at}_word")))
        met = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names)]
        rows = rows.join(listed, [*met, F.col(place) == F.col(f"_{at}_word")], "left_semi")
    return rows


def _joined(columns: Sequence[str]) -> Column:
    """The columns with spaces between them; null where one of them is null."""
    parts = [F.col(columns[0])]
    for c in columns[1:]:
        parts += [F.lit(" "), F.col(c)]
    return F.concat(*parts)


def top_k(counts: DataFrame, k: int = TOP, by: Sequence[str] = ()) -> DataFrame:
    """The ``k`` highest counts, overall or per ``by``; ties go by keyword."""
    order = [F.desc("count"), F.asc("keyword")]
    if not by:
        return counts.orderBy(*order).limit(k)
    window = Window.partitionBy(*by).orderBy(*order)
    return (
        counts.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") <= k)
        .drop("_rank")
    )


def _word_counts(titles: DataFrame, by: Sequence[str], title: str = "title",
                 group_bytes: int = GROUP_BYTES, **text) -> DataFrame:
    """Single words of ``keyword_counts``, a group's all in one task where that can be.

    Titles are smaller than the counts every task has of their words by group, so they are shuffled,
    by group: its words are counted, and can be ranked, where its titles are. Groups measured at
    more than ``group_bytes`` of titles are counted by all tasks, as everything is without groups.
    """
    plain = dict(by=by, title=title, sizes=(1,), **text)
    if not by or isinstance(titles.schema[title].dataType, ArrayType) or text.get("dedupe_titles"):
        return keyword_counts(titles, **plain)
    titles = titles.select(*dict.fromkeys([*by, *text.get("row_id", ()), title]))
    measured = titles.groupBy(*by).agg(
        F.coalesce(F.sum(F.octet_length(title)), F.lit(0)).alias("_bytes")).checkpoint()
    large = F.col("_bytes") > group_bytes
    found = measured.agg(F.count_if(large).alias("large"), F.count_if(~large).alias("small")).first()
    if not found["large"]:
        return keyword_counts(titles.repartition(*by), **plain)
    if not found["small"]:
        return keyword_counts(titles, **plain)
    # As few as the text has times ``group_bytes``. Groups without a name are groups too.
    hot = F.broadcast(measured.where(large).select(*(F.col(c).alias(f"_hot_{c}") for c in by)))
    met = [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in by]
    dealt = titles.join(hot, met, "left_anti").repartition(*by)
    return keyword_counts(dealt, **plain).unionByName(
        keyword_counts(titles.join(hot, met, "left_semi"), **plain))


def top_keywords(titles: DataFrame, k: int = TOP, by: Sequence[str] = (),
                 sizes: Sequence[int] = (1, 2), max_bytes: int = MAX_BROADCAST_BYTES,
                 group_bytes: int = GROUP_BYTES, **text) -> DataFrame:
    """``top_k`` of ``keyword_counts``, exactly, without counting every longer n-gram.

    An n-gram comes up no more often than any of its words. So where single words are counted too,
    one that is among the top has only words that are no rarer than the ``k``-th word of its group.
    The words are counted first; n-grams are made of all titles, and counted where all their words
    are among those. What words are left is measured: beyond ``max_bytes``, say in groups where all
    are equally rare, every n-gram is counted. Words as rare as the ``k``-th of a group all stay and
    are ranked in one task, sorted on its disk.
    """
    plain = dict(by=by, max_bytes=max_bytes, **text)
    if 1 not in sizes or len(set(sizes)) == 1 or titles.isStreaming or text.get("lemmas") is not None:
        return top_k(keyword_counts(titles, sizes=sizes, **plain), k, by)
    shared_dir(titles.sparkSession)
    order = Window.partitionBy(*(by or [F.lit(0)])).orderBy(F.desc("count"))
    words = (
        _word_counts(titles, group_bytes=group_bytes, **plain)
        .withColumn("_rank", F.rank().over(order))
        .where(F.col("_rank") <= k).drop("_rank").checkpoint()
    )
    among = words.select(*by, F.col("keyword").alias("_word"))
    longer = [n for n in sizes if n > 1]
    if fits_broadcast(among, max_bytes):
        plain["among"] = among
    grams = keyword_counts(titles, sizes=longer, **plain)
    return top_k(words.unionByName(grams), k, by)


def top_of_latest(counts: DataFrame, label: str = "hour", k: int = TOP) -> DataFrame:
    """The top of the newest label; labels sort as text, being zero-padded."""
    newest = counts.agg(F.max(label)).scalar()
    return top_k(counts.where(F.col(label) == newest), k)


def titles_in_chunks(headlines: DataFrame, by: Sequence[str], title: str = "title",
                     chunk_size: int = 10_000, chunk_bytes: int = 32 << 20) -> DataFrame:
    """All titles per group as arrays of about ``chunk_size`` distinct titles each.

    Equal titles are one element with a count ``n``. A group above ``chunk_size`` titles or
    ``chunk_bytes`` of text is spread over several ``chunk`` rows by the hash of its titles,
    so no single row or task has to hold a hot group.
    """
    distinct = (
        one_title_per_row(headlines, title)
        .groupBy(*by, F.col(title).alias("title")).agg(F.count("*").alias("n"))
    )
    large = (
        distinct.groupBy(*by).agg(F.greatest(
            F.ceil(F.count("*") / chunk_size),
            F.ceil(F.sum(F.octet_length("title")) / chunk_bytes)).alias("_chunks"))
        .where("_chunks > 1")
    )
    number = F.conv(F.substr(F.md5(F.col("title").cast("binary")), F.lit(1), F.lit(8)), 16, 10)
    chunk = F.when(F.col("_chunks").isNull(), F.lit(0)).otherwise(
        F.pmod(number.cast("long"), F.col("_chunks")))
    # Not measured, which would run the first aggregate once more: the salted join copes
    # with any size, and the engine broadcasts ``large`` where its shuffle turns out small.
    return (
        lookup_join(distinct, large, list(by), "left", spread_by=["title"], small=False)
        .withColumn("chunk", chunk.cast("int"))
        .groupBy(*by, "chunk")
        .agg(F.array_sort(F.collect_list(F.struct("title", "n"))).alias("titles"))
    )
