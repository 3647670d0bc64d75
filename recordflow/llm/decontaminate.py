"""Benchmark decontamination: hash windows of test items, scan documents, verify, remove.

Only DataFrame functions are used. The windows of all items are a hash table on the side of a
join; it is broadcast up to ``MAX_BROADCAST_WINDOWS`` distinct windows, which are counted first,
and beyond that Spark shuffles both sides. Document windows are hashed, looked up and compared
word by word inside one generated loop, so only real hits leave it.

Nulls: a null text has no words and so no hits; a null document ID is an ID like any other; a
null item ID takes part in finding hits but is not listed. Empty texts have no words. Repeated
rows each get the same result. Empty tables: no items, no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordflow.llm.common import CASED_PIECE, CASED_WORD, attach, joined_text, keyed, word_count, words

WINDOW_WORDS = 10
MAX_BROADCAST_WINDOWS = 200_000


NO_PLACES = "cast(array() as array<struct<start:int,hash:bigint>>)"


def _places(length: int) -> Column:
    """Start, from 0, and hash of every window of `length` of ``_words``."""

    def place(i: Column) -> Column:
        return F.struct(i.alias("start"), F.xxhash64(F.slice("_words", i + 1, length)).alias("hash"))

    starts = F.sequence(F.lit(0), F.size("_words") - length)
    return F.when(F.size("_words") >= length, F.transform(starts, place)).otherwise(F.expr(NO_PLACES))


def benchmark_windows(
    benchmark: DataFrame,
    size: int = WINDOW_WORDS,
    id_column: str = "item_id",
    text_column: str = "text",
) -> DataFrame:
    """``_hash, _length, _window, _items``: each distinct window and the items it is in.

    An item of fewer words than `size`, but not none, is one window.
    """
    items = benchmark.select(F.col(id_column).cast("string").alias("_item"), words(F.col(text_column)).alias("_words"))
    length = F.least(F.lit(size), F.size("_words"))
    start = F.explode(F.sequence(F.lit(1), F.size("_words") - length + 1))
    return (
        items.filter(F.size("_words") > 0)
        .select("_item", "_words", length.alias("_length"), start.alias("_start"))
        .groupBy(F.slice("_words", F.col("_start"), F.col("_length")).alias("_window"), "_length")
        .agg(F.collect_set("_item").alias("_items"))
        .select(F.xxhash64("_window").alias("_hash"), "_length", "_window", "_items")
    )


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``_id, _print, n_hit, items, spans`` of every document with a hit.

    ``spans`` are word intervals (``start`` included, ``stop`` not), in order; together they cover
    the hit words. Intervals that add no word are left out.
    """
    windows = benchmark_windows(benchmark, size, item_column, item_text)
    lengths = sorted(r[0] for r in windows.select("_length").distinct().limit(size).collect())
    known = windows.count() if lengths else 0
    docs = keyed(docs, id_column, text_column)
    worded = docs.select("_id", "_print", words(F.col("_text")).alias("_words"))
    places = F.concat(*[_places(n) for n in lengths or [size]])
    # The outer form: of the other, the optimizer makes a filter that computes the places again.
    scanned = worded.select("_id", "_print", "_words", F.explode_outer(places).alias("_w"))
    table = F.broadcast(windows) if known <= MAX_BROADCAST_WINDOWS else windows
    same = (F.col("_w.hash") == F.col("_hash")) & (
        F.slice("_words", F.col("_w.start") + 1, F.col("_length")) == F.col("_window")
    )
    found = scanned.join(table, same).select(
        "_id",
        "_print",
        F.col("_w.start").alias("_start"),
        (F.col("_w.start") + F.col("_length")).alias("_stop"),
        "_items",
    )
    before = Window.partitionBy("_id", "_print").orderBy("_start", "_stop").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.greatest("_start", F.coalesce(F.max("_stop").over(before), F.lit(0)))
    span = F.struct(F.col("_reach").alias("start"), F.col("_stop").alias("stop"))
    return (
        found.withColumn("_reach", reach)
        .groupBy("_id", "_print")
        .agg(
            F.sum(F.greatest(F.col("_stop") - F.col("_reach"), F.lit(0))).cast("long").alias("n_hit"),
            F.collect_set("_items").alias("_all"),
            F.array_sort(F.collect_list(F.when(F.col("_stop") > F.col("_reach"), span))).alias("spans"),
        )
        .select("_id", "_print", "n_hit", F.array_distinct(F.flatten("_all")).alias("items"), "spans")
    )


def report(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """Every document with its numbers of words, of hit words and of items found in it."""
    found = hits(docs, benchmark, id_column=id_column, text_column=text_column, **options).drop("spans")
    base = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(text_column).alias("_text"),
        word_count(F.col(text_column)).alias("n_words"),
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.coalesce("items", F.expr("cast(array() as array<string>)"))
    return attach(base, found, "doc_id", "_text").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(joined_text(items).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    remove: str = "documents",
    id_column: str = "doc_id",
    text_column: str = "text",
    **options,
) -> DataFrame:
    """`docs` without the documents that hold a window of an item, or without the hit words.

    ``remove="spans"`` takes out every hit word and what separates it from the next word.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove: {remove}")
    found = hits(docs, benchmark, id_column=id_column, text_column=text_column, **options)
    marked = attach(docs, found.select("_id", "_print", F.col("spans").alias("_spans")), id_column, text_column)
    if remove == "documents":
        return marked.filter(F.col("_spans").isNull()).select(*docs.columns)
    pieces = F.regexp_extract_all(F.col(text_column), F.lit(CASED_PIECE), F.lit(0))
    # Words and separators take turns, so a piece's word number follows from its place.
    lead = F.when(F.col(text_column).rlike(CASED_WORD), 0).otherwise(1)
    in_span = lambda i: F.exists("_spans", lambda s: (s["start"] <= i) & (i < s["stop"]))
    kept = F.filter("_pieces", lambda piece, k: ~in_span(F.floor((k - F.col("_lead")) / 2)))
    return (
        marked.withColumns({"_pieces": F.when(F.col("_spans").isNotNull(), pieces), "_lead": lead})
        .withColumn(text_column, F.when(F.col("_spans").isNull(), F.col(text_column)).otherwise(F.array_join(kept, "")))
        .select(*docs.columns)
    )
