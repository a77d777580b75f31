"""Benchmark decontamination by winnowing.

Words are hashed; each run of ``gram`` words is a gram, and of every ``window - gram + 1``
consecutive grams the least is kept as a fingerprint. Any span of ``window`` words that a document
shares with an item has the same least gram in both, so no such span is missed. Fingerprints are
joined, then the documents that have one extend the hit: each window of ``window`` words around a
matching gram is compared with the items' windows word by word.

All in DataFrame functions. The texts are read once for the fingerprints, and a second time,
in a join by id and digest, for documents with a matching fingerprint alone. The items' tables are broadcast
only after a count against ``BROADCAST_ROWS``; beyond it the joins shuffle. Generators are outer
ones, since Spark would evaluate the arrays a second time in a filter before an inner one.

Results for odd input: null and empty texts have no words; an item without words or id is
ignored; items of fewer words than a window are one window of their own length; repeated items
give the same id once; documents without an id have words but no hits; rows that repeat an id are documents
of their own, told apart by the digest of their text. A text of any length takes time in proportion to it and to its
matching fingerprints. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.llm.shared import ascii_lower
from glyphmill.session import materialize

#: Everything but these characters makes words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Tables of items up to so many rows are broadcast: at some 100 bytes a row, 20 MB at most.
BROADCAST_ROWS = 200_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(ascii_lower(text), F.lit("")), SEPARATORS), lambda w: w != "")


def _upto(n: Column) -> Column:
    """0 to n - 1; empty where n is not positive."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def _grams(df: DataFrame, gram: int) -> DataFrame:
    """``df`` with the hash of each run of ``gram`` words of ``words``."""
    df = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    places = _upto(F.size("hashes") - (gram - 1))
    grams = F.transform(places, lambda i: F.xxhash64(*[F.get("hashes", i + j) for j in range(gram)]))
    return df.withColumn("grams", grams).drop("hashes")


def _fingerprints(df: DataFrame, span: int) -> DataFrame:
    """``df`` with the least of every ``span`` consecutive ``grams``, runs of one value once."""
    places = _upto(F.size("grams") - (span - 1))
    least = F.transform(places, lambda i: F.least(*[F.get("grams", i + j) for j in range(span)]))
    df = df.withColumn("least", least)
    changes = F.filter("least", lambda x, i: (i == 0) | (x != F.get("least", i - 1)))
    return df.withColumn("fingerprints", changes).drop("least")


def _bounded(df: DataFrame) -> DataFrame:
    """Stored ``df``, with a broadcast hint if a count shows it to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _windows(words: str, starts: Column, length: int) -> Column:
    return F.transform(
        starts, lambda s: F.struct(s.alias("s"), F.array_join(F.slice(words, s + 1, length), " ").alias("key"))
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    gram: int = 5,
) -> DataFrame:
    """Per document: ``id, n_words, n_hit, items`` (array of strings, sorted).

    ``n_hit`` counts the words inside any occurrence of an item's window of ``window`` words.
    """
    span = window - gram + 1
    item_words = materialize(
        items.select(F.col(item_id).alias("item"), words_of(F.col(item_text)).alias("words")).filter(
            F.col("item").isNotNull() & (F.size("words") > 0)
        ),
        "items",
    )
    full = item_words.filter(F.size("words") >= window)
    prints = materialize(
        _fingerprints(_grams(full, gram), span)
        .select(F.explode_outer("fingerprints").alias("value"))
        .filter(F.col("value").isNotNull())
        .distinct(),
        "item-fingerprints",
    )
    starts = _upto(F.size("words") - (window - 1))
    full_windows = full.select("item", F.inline_outer(_windows("words", starts, window))).select(
        "item", F.lit(window).alias("length"), "key"
    )
    short = item_words.filter(F.size("words") < window).select(
        "item", F.size("words").alias("length"), F.array_join("words", " ").alias("key")
    )
    item_windows = materialize(full_windows.union(short).distinct(), "item-windows")
    lengths = sorted(r.length for r in short.select("length").distinct().collect())  # fewer than window

    # One row per document with its number of words, one for each matching fingerprint.
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.md5(text).alias("digest"), text.alias("text"))
    worded = texts.select("id", "digest", words_of(F.col("text")).alias("words"))
    values = (
        _fingerprints(_grams(worded, gram), span)
        .select("id", "digest", F.size("words").alias("n_words"), F.array_distinct("fingerprints").alias("f"))
        .select("id", "digest", "n_words", F.explode_outer(F.concat(F.array(F.lit(None).cast("long")), "f")).alias("value"))
        .join(_bounded(prints.withColumn("known", F.lit(True))), "value", "left")
        .filter(F.col("known") | F.col("value").isNull())
        .select("id", "digest", "n_words", "value")
    )
    values = materialize(values, "document-fingerprints")
    counted = values.filter(F.col("value").isNull()).select("id", "digest", "n_words")
    document = ["id", "digest"]
    seeds = (
        values.filter(F.col("value").isNotNull() & F.col("id").isNotNull())
        .groupBy(*document)
        .agg(F.collect_set("value").alias("values"))
    )

    matching = texts.join(seeds, document).select(*document, "values", words_of(F.col("text")).alias("words"))
    seeded = _grams(matching, gram)
    seeded = seeded.withColumn("seed", F.transform("grams", lambda g: F.array_contains("values", g)))
    near = F.filter(
        _upto(F.size("words") - (window - 1)), lambda s: F.exists(F.slice("seed", s + 1, span), lambda x: x)
    )
    hits = seeded.select(*document, F.inline_outer(_windows("words", near, window))).withColumn("length", F.lit(window))
    for length in lengths:
        every = worded.filter(F.col("id").isNotNull()).select(
            *document, F.inline_outer(_windows("words", _upto(F.size("words") - (length - 1)), length))
        )
        hits = hits.unionByName(every.withColumn("length", F.lit(length)))
    found = (
        hits.join(_bounded(item_windows), ["key", "length"])
        .groupBy(*document)
        .agg(
            F.array_sort(F.collect_set(F.struct("s", (F.col("s") + F.col("length")).alias("e")))).alias("spans"),
            F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"),
        )
    )
    # Spans in order of their start: each adds what reaches beyond the ends so far.
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(a["end"], x["s"]))).alias("n"),
            F.greatest(a["end"], x["e"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    found = found.select(*document, covered.cast("long").alias("n_hit"), "items")
    return counted.join(found, document, "left").select(
        "id",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
