"""Document fingerprints: one-permutation MinHash, densified, in packed low-order bits.

Every five-word shingle is hashed once. The top bits of the hash name one of 128 bins, and each
bin keeps its least hash. An empty bin takes the value of the bin that a random order of its own,
the same for all documents, meets first: a few hashed probes, then the least hash of (bin, bin)
among the filled ones, so the first filled bin is always found. Of each bin's hash the low eight
bits are stored; the likeness of two fingerprints takes off the agreement that bits have by
chance.

DataFrame operations only. One sorted array per text holds the hashes and a mark at the start of
each bin, so that bins are read off in one pass.

Defined results: words are runs of letters, digits and underscores in lower case; a text of fewer
than five words is one shingle; a text without words, a null one included, has an empty
fingerprint, which is like another empty one (1) and unlike all others (0); equal rows have equal
results; other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wirecount.llm.common import text_of

WIDTH, BINS, BITS = 5, 128, 8
#: Hashed probes of an empty bin before all filled bins are ranked for it.
PROBES = 12
TOP = 57  # a bin is the hash's bits from here on
#: Code points of a text that order rows of one key, and rows drawn per range to find the bounds.
HEAD, SAMPLED = 32, 100


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are values: a generator keeps the optimizer from repeating them."""
    kept = df.columns
    values = F.struct(*(c.alias(name) for name, c in columns.items()))
    return df.withColumn("held_", F.explode(F.array(values))).select(
        *kept, *(F.col(f"held_.{name}").alias(name) for name in columns))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda w: w != "")


def _hashes(words: str) -> Column:
    n = F.size(words)
    runs = F.transform(
        F.slice(words, 1, F.greatest(n - (WIDTH - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, WIDTH))))
    return (F.when(n >= WIDTH, runs)
            .when(n >= 1, F.array(F.xxhash64(F.array_join(words, " "))))
            .otherwise(F.array().cast("array<bigint>")))


def _marks() -> Column:
    """The least hash that each bin could hold."""
    return F.transform(F.sequence(F.lit(-BINS // 2), F.lit(BINS // 2 - 1)),
                       lambda j: F.shiftleft(j.cast("long"), TOP))


def _is_mark(x: Column) -> Column:
    return x.bitwiseAND(F.lit((1 << TOP) - 1)) == 0


def _bin(x: Column) -> Column:
    return F.shiftright(x, TOP)


def bins(df: DataFrame, text: str, name: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``name``: the low bits of every bin after densification, or an empty array."""
    # Which bins an empty one asks, in order; the same for all documents.
    asked = F.transform(F.sequence(F.lit(0), F.lit(BINS * PROBES - 1)),
                        lambda k: F.pmod(F.xxhash64(k), F.lit(BINS)).cast("int"))
    table = F.array(*(F.lit(p) for p in df.sparkSession.range(1).select(asked).first()[0]))
    rows = held(df.select(*keep, F.col(text).alias("text_")), words_=_words(F.col("text_")))
    rows = held(rows.select(*keep, "words_"), hashes_=_hashes("words_"))
    rows = held(rows.select(*keep, "hashes_"),
                sorted_=F.sort_array(F.concat("hashes_", _marks())))
    # Of each bin its mark and the hash after it.
    rows = held(rows.select(*keep, "sorted_"), heads_=F.filter(
        "sorted_", lambda x, i: _is_mark(x) | _is_mark(F.get("sorted_", i - 1))))
    low = (1 << BITS) - 1

    def filled(x, i):
        after = F.get("heads_", i + 1)
        return F.when(~_is_mark(x), F.lit(-2)).when(
            after.isNull() | _is_mark(after), F.lit(-1)).otherwise(
            after.bitwiseAND(F.lit(low)).cast("int"))

    rows = held(
        rows.select(*keep, "heads_"),
        sparse_=F.filter(F.transform("heads_", filled), lambda v: v != -2),
        found_=F.filter("heads_", lambda x: ~_is_mark(x)))

    def densified(v, j):
        tried = [F.nullif(F.get("sparse_", F.get(table, j * PROBES + a)), F.lit(-1))
                 for a in range(PROBES)]
        # The filled bin of least rank; its low bits ride along in the low bits of the rank.
        ranked = F.array_min(F.transform("found_", lambda x: F.xxhash64(j, _bin(x)).bitwiseAND(
            F.lit(~low)).bitwiseOR(x.bitwiseAND(F.lit(low)))))
        return F.when(v >= 0, v).otherwise(F.coalesce(
            *tried, ranked.bitwiseAND(F.lit(low)).cast("int")))

    dense = F.when(F.size("found_") > 0, F.transform("sparse_", densified)).otherwise(
        F.array().cast("array<int>"))
    return held(rows.select(*keep, "sparse_", "found_"), **{name: dense}).drop(
        "sparse_", "found_")


def packed(low_bits: str) -> Column:
    """The fingerprint as text: two hexadecimal digits per bin."""
    return F.array_join(F.transform(low_bits, lambda v: F.lpad(F.lower(F.hex(v)), 2, "0")), "")


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity, without the agreement that bits have by chance."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / BINS
    chance = 1 / (1 << BITS)
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
            .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), (same - chance) / (1 - chance))))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, bins, fingerprint`` of every row."""
    rows = docs.select(F.col(key).alias("key_"), text_of(text).alias("text_"))
    return bins(rows, "text_", "bins", ["key_"]).select(
        F.col("key_").alias(key), "bins", packed("bins").alias("fingerprint"))


def _order(key: str, tie: str) -> Column:
    """Where a row stands: by key, nulls first, then by the head of ``tie`` and its hash."""
    return F.struct(F.col(key).isNotNull().alias("some"), F.col(key).alias("key"),
                    F.substr(tie, F.lit(1), F.lit(HEAD)).alias("head"),
                    F.xxhash64(tie).alias("hash"))


def _cuts(places: DataFrame, parts: int) -> tuple[Column | None, list[Column]]:
    """The first of all places ``at`` and those that begin the other ranges, as values."""
    seen = places.agg(F.count("*").alias("n"), F.min("at").alias("least")).first()
    if not seen["n"]:
        return None, []
    drawn = SAMPLED * parts
    some = places if seen["n"] <= drawn else places.where(F.rand(1) < drawn / seen["n"])
    found = [r["at"] for r in some.orderBy("at").collect()]
    kind = places.schema["at"].dataType
    begins = dict.fromkeys(found[len(found) * i // parts] for i in range(1, parts) if found)
    begins.pop(seen["least"], None)

    def value(row):
        return F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, kind)))

    return value(seen["least"]), [value(r) for r in begins]


def with_next(df: DataFrame, key: str, tie: str, columns: list[str],
              keys: DataFrame | None = None) -> DataFrame:
    """``df`` with ``next``, the ``columns`` of the row after it by ``key`` and, where keys are
    equal, by the first ``HEAD`` code points of ``tie`` and then its hash; the first row comes
    after the last.

    Rows are dealt to ranges of this order, one per shuffle partition, between quantiles of a
    sample of bounded size, so many rows of one key (or without) lie in many ranges. The first
    row of a range also goes to the range before it, and the first of all behind the last.
    ``keys`` holds the same keys and ties as ``df`` where they are cheaper to read.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = df if keys is None else keys
    least, cuts = _cuts(source.select(_order(key, tie).alias("at")), parts)
    at = F.col("at_")
    # Ranges are looked for in two steps: among every few cuts, then between two of these.
    few = max(1, int(len(cuts) ** 0.5))
    bounds, coarse = F.array(*cuts), F.array(*cuts[::few])

    def below(some):
        return F.size(F.filter(some, lambda c: c <= at))

    rows = held(df, at_=_order(key, tie))
    rows = held(rows, coarse_=below(coarse) if cuts else F.lit(0))
    start = (F.col("coarse_") - 1) * few
    rows = held(rows, part_=F.when(F.col("coarse_") == 0, F.lit(0)).otherwise(
        start + below(F.slice(bounds, start + 1, few))) if cuts else F.lit(0))

    def place(part, guest):
        return F.struct(part.cast("int").alias("part"), F.lit(guest).alias("guest"))

    places = [place(F.col("part_"), 0)]
    if cuts:
        places.append(F.when(F.get(bounds, F.col("part_") - 1).eqNullSafe(at),
                             place(F.col("part_") - 1, 1)))
    if least is not None:
        places.append(F.when(at.eqNullSafe(least), place(F.lit(len(cuts)), 2)))
    dealt = rows.withColumn("place_", F.explode(
        F.filter(F.array(*places), lambda p: p.isNotNull())))
    order = Window.partitionBy("place_.part").orderBy("place_.guest", "at_")
    ahead = F.lead(F.struct(*columns)).over(order)
    return dealt.withColumn("next", ahead).where("place_.guest = 0").drop(
        "place_", "at_", "coarse_", "part_")
