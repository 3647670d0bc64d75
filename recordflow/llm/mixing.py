"""Mixing sources to target weights, by a splitting tree of hypergeometric draws.

Texts are cut into blocks of ``BLOCK_WORDS`` words. A source's target says how many full passes of
its blocks the mix takes, and how far it goes into one more, in a permuted order; the last block is
cut short, so the words taken are the target, rounded. That makes an exact quota of blocks for
each source. A tree splits the quotas among output shards of equal size: at each node the left
half's share of every source is a multivariate hypergeometric draw, so a shard is a random sample
without replacement of the whole mix. A shard's share of a source is a range of the source's
permuted blocks; ranges are disjoint and cover all. Inside a shard the order is shuffled.

Only DataFrame functions are used. Draws come from hashes of a seed, node and source, so reruns agree.
A source's permuted order is cut into stretches by the first digits of a hash: numbers and word
positions are running sums inside a stretch and over the stretches' totals, so no source is
gathered in a task. One tree node is a row with the quotas of its sources that aren't 0; sources
are meant to be thousands at most.

A document is its ID, source and text. Rows that repeat all three are copies: each has its own
blocks, and as copies are alike it doesn't matter which is which. A null source is a source of its
own, the last in order; a null ID reads as an empty one in the permutation but stays null. Null
and empty texts have no words, are in no shard and in the report with 0. With no words at all
every target is 0; an empty table gives an empty result. Only the named columns are read, so
others can't clash.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordflow.llm.common import written
from recordflow.operators.joins import same_key

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 512
SHARD_BLOCKS = 4_096
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
STRETCH_BLOCKS = 4_096
SEED = 11
# Attempts of one draw. About two of three are taken, so the last is reached once in 10^25 draws.
ATTEMPTS = 64
# Fixed values of the ratio-of-uniforms method: 2 * sqrt(2 / e) and 3 - 2 * sqrt(3 / e).
WIDTH, OFFSET = 1.7155277699214135, 0.8989161620588988
# So many levels of the tree are one plan; then its nodes are written and dealt out to tasks.
LEVELS_AT_ONCE = 3
KEY = ("_id", "_source", "_print", "_size")


def documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """``_id, _source, _print, _size`` (words) and ``_copies`` of every document."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("_id"),
        F.col(source_column).alias("_source"),
        F.substring(F.md5(text.cast("binary")), 1, 16).alias("_print"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("_size"),
    )
    return written(rows.groupBy(*KEY).agg(F.count("*").alias("_copies")), "documents")


def _words(n: int) -> Column:
    """A number of words, a long even where it would fit an integer: a weight times it need not."""
    return F.lit(n).cast("long")


def targets(units: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """``_source, _s`` (its number in order), ``source_size, blocks, target`` of every source.

    Targets share all words by weight. One over `most` times its source stops there, and the rest
    share what is left, again until none is above.
    """
    blocks = F.ceil(F.col("_size") / BLOCK_WORDS) * F.col("_copies")
    sizes = units.groupBy("_source").agg(
        F.sum(F.col("_size") * F.col("_copies")).alias("source_size"), F.sum(blocks).cast("long").alias("blocks")
    )
    # One row per source.
    number = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_s") % len(weights) + 1).cast("int"))
    sources = written(sizes.withColumn("_s", number.cast("long")).withColumn("weight", weight), "sources")
    most_words = most * F.col("source_size")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first().n
    left, share = total, None
    while True:
        at_most = F.lit(False) if share is None else F.col("weight") * _words(share[0]) / share[1] >= most_words
        sums = sources.agg(
            F.coalesce(F.sum(F.when(at_most, most_words)), F.lit(0)).alias("stopped"),
            F.sum(F.when(~at_most, F.col("weight"))).alias("weight"),
        ).first()
        now = (total - sums.stopped, sums.weight)
        if now == share or not sums.weight:
            break
        share = now
    target = most_words if share is None else F.least(most_words.cast("double"), F.col("weight") * _words(share[0]) / share[1])
    return sources.select("_source", "_s", "source_size", "blocks", target.cast("double").alias("target"))


def _uniform(*parts: Column) -> Column:
    """A number between 0 and 1, never 0, from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / float(1 << 53)


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _struct(**columns: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in columns.items()])


def log_factorial(n: Column) -> Column:
    """By Stirling's series at n + 8, less the logarithms of n + 1 to n + 7."""

    def series(x: Column) -> Column:
        return (x - 0.5) * F.log(x) - x + 0.9189385332046727 + (1 / 12.0 - (1 / 360.0 - 1 / (1260 * x * x)) / (x * x)) / x

    factors = F.aggregate(F.sequence(F.lit(1), F.lit(7)), F.lit(1.0), lambda product, k: product * (n + k))
    return _named(n + 8.0, series) - F.log(factors)


def hypergeometric(good: Column, bad: Column, drawn: Column, *seed: Column) -> Column:
    """How many of `drawn` are good, without replacement: ratio of uniforms over the symmetric half."""

    def logs(k: Column, z: Column) -> Column:
        parts = F.array(z, k["few"] - z, k["m"] - z, k["many"] - k["m"] + z)
        return F.aggregate(parts, F.lit(0.0), lambda total, n: total + log_factorial(n))

    def halves(a: Column) -> Column:
        """The case with few good ones and few draws, to which the others are symmetric."""
        few, all_ = F.least(a["good"], a["bad"]), a["good"] + a["bad"]
        return _struct(few=few, many=all_ - few, all=all_, m=F.least(a["drawn"], all_ - a["drawn"]))

    def shape(h: Column) -> Column:
        share = h["few"] / h["all"]
        spread = F.sqrt((h["all"] - h["m"]) * h["m"] * share * (1 - share) / F.greatest(h["all"] - 1, F.lit(1.0)) + 0.5)
        mode = F.floor((h["m"] + 1) * ((h["few"] + 1) / (h["all"] + 2))).cast("double")
        return _struct(
            few=h["few"], many=h["many"], m=h["m"], mode=mode, centre=h["m"] * share + 0.5, width=WIDTH * spread + OFFSET, top=logs(h, mode)
        )

    def attempt(k: Column, i: Column) -> Column:
        def judged(t: Column) -> Column:
            inside = (t["z"] >= 0) & (t["z"] <= F.least(k["m"], k["few"]))
            return F.when(inside & (2 * F.log(t["x"]) <= k["top"] - logs(k, t["z"])), t["z"]).otherwise(F.lit(-1.0))

        x, y = _uniform(*seed, i, F.lit("x")), _uniform(*seed, i, F.lit("y"))
        return _named(_struct(x=x, y=y), lambda u: _named(
            _struct(x=u["x"], z=F.floor(k["centre"] + k["width"] * (u["y"] - 0.5) / u["x"]).cast("double")), judged
        ))

    def found(k: Column) -> Column:
        z = F.aggregate(F.sequence(F.lit(1), F.lit(ATTEMPTS)), F.lit(-1.0), lambda z, i: F.when(z >= 0, z).otherwise(attempt(k, i)))
        return _named(z, lambda z: F.when(z >= 0, z).otherwise(k["mode"]))

    def turned(a: Column) -> Column:
        m = F.least(a["drawn"], a["good"] + a["bad"] - a["drawn"])
        few = _named(_named(_named(a, halves), shape), found)
        of_few = _named(few, lambda z: F.when(a["good"] > a["bad"], m - z).otherwise(z))
        of_all = _named(of_few, lambda z: F.when(m < a["drawn"], a["good"] - z).otherwise(z))
        simple = F.when((a["good"] == 0) | (a["drawn"] == 0), F.lit(0.0)).when(a["bad"] == 0, a["drawn"])
        return simple.when(a["drawn"] == a["good"] + a["bad"], a["good"]).otherwise(of_all).cast("long")

    return _named(_struct(good=good.cast("double"), bad=bad.cast("double"), drawn=drawn.cast("double")), turned)


def split_quotas(quotas: DataFrame, shards: int, size: int, seed: int = SEED) -> DataFrame:
    """``shard, quotas`` (array of ``s, q``): the `quotas` (``_s, q``) dealt to shards 0 to `shards` - 1.

    All shards have `size` blocks but the last, which has the rest.
    """
    item = "array<struct<s:bigint,q:bigint>>"
    pairs = F.array_sort(F.collect_list(F.struct(F.col("_s").alias("s"), F.col("q").alias("q"))))
    # One row with an entry per source.
    nodes = quotas.filter("q > 0").agg(pairs.cast(item).alias("quotas")).select(
        F.lit(0).cast("long").alias("low"), F.lit(shards).cast("long").alias("high"), "quotas"
    )

    def draw(state: Column, source: Column) -> Column:
        """One source after the other: its share of what the left half still lacks."""
        rest = state["rest"] - source["q"]
        x = hypergeometric(source["q"], rest, state["lacks"], F.lit(seed), F.col("low"), F.col("high"), source["s"])
        return _named(x, lambda n: _struct(
            rest=rest, lacks=state["lacks"] - n, out=F.concat(state["out"], F.array(_struct(s=source["s"], q=n)))
        ))

    levels = max(0, (shards - 1).bit_length())
    for level in range(levels):
        middle = F.floor((F.col("low") + F.col("high") + 1) / 2).cast("long")
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda n, x: n + x["q"])
        lacks = F.least((middle - F.col("low")) * size, total)
        start = F.struct(total.alias("rest"), lacks.alias("lacks"), F.array().cast(item).alias("out"))
        left = F.when(middle < F.col("high"), F.aggregate("quotas", start, draw, lambda s: s["out"])).otherwise(F.col("quotas"))
        split = nodes.select("low", "high", middle.alias("middle"), "quotas", left.alias("left"))
        # Without a rest for the right half there is nothing to be split.
        right = F.zip_with("quotas", "left", lambda a, b: F.struct(a["s"].alias("s"), (a["q"] - b["q"]).alias("q")))
        halves = F.array(
            F.struct(F.col("low"), F.col("middle").alias("high"), F.col("left").alias("quotas")),
            F.struct(F.col("middle").alias("low"), F.col("high"), right.alias("quotas")),
        )
        nodes = split.select(F.explode(halves).alias("half")).select(
            "half.low", "half.high", F.filter("half.quotas", lambda x: x["q"] > 0).alias("quotas")
        ).filter("low < high")
        if level % LEVELS_AT_ONCE == LEVELS_AT_ONCE - 1 or level == levels - 1:
            nodes = written(nodes.repartition("low"), "nodes")
    return nodes.select(F.col("low").alias("shard"), "quotas")


@dataclass(frozen=True)
class Mix:
    """``drawn``: the blocks of all shards. ``units``: the documents. ``sources``: their targets."""

    drawn: DataFrame
    units: DataFrame
    sources: DataFrame


def permuted_blocks(units: DataFrame, sources: DataFrame, seed: int = SEED) -> DataFrame:
    """``_s, number``, the key, ``copy, block, words``: every block the mix takes, numbered by source."""
    words = F.round("target").cast("long")
    known = sources.select(
        F.col("_source").alias("_of"), "_s", "blocks", "source_size", words.alias("wanted"),
        F.when(F.col("source_size") > 0, F.ceil(words / F.col("source_size"))).otherwise(0).cast("long").alias("passes"),
    ).filter("wanted > 0")
    n_blocks = F.ceil(F.col("_size") / BLOCK_WORDS).cast("long")
    here = units.filter("_size > 0").join(known, same_key(units["_source"], known["_of"])).withColumn("_n", n_blocks)
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") * F.col("_n") * F.col("passes") - 1))
    blocks = here.select(*KEY, "_s", "_n", "blocks", "source_size", "wanted", "passes", each.alias("_each")).select(
        *KEY, "_s", "blocks", "source_size", "wanted",
        F.floor(F.col("_each") / F.col("passes") / F.col("_n")).cast("long").alias("copy"),
        (F.floor(F.col("_each") / F.col("passes")) % F.col("_n")).cast("long").alias("block"),
        (F.col("_each") % F.col("passes")).alias("pass"),
    )
    blocks = blocks.withColumn("words", F.least(F.lit(BLOCK_WORDS), F.col("_size") - F.col("block") * BLOCK_WORDS))
    place = F.concat_ws(":", F.lit(seed), "pass", F.coalesce(F.col("_id").cast("string"), F.lit("")), "_print", "copy", "block")
    there = units.agg(F.coalesce(F.sum(F.col("_copies") * n_blocks), F.lit(0)).alias("n")).first().n
    digits = 1
    while STRETCH_BLOCKS * 16**digits < there:
        digits += 1
    blocks = blocks.withColumn("_place", F.md5(place.cast("binary"))).withColumn("_stretch", F.substring("_place", 1, digits))
    inside = Window.partitionBy("_s", "pass", "_stretch").orderBy("_place", "_size")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = blocks.withColumns({"number": F.row_number().over(inside).cast("long"), "before": F.sum("words").over(upto) - F.col("words")})
    along = Window.partitionBy("_s", "pass").orderBy("_stretch")
    totals = blocks.groupBy("_s", "pass", "_stretch").agg(F.count("*").alias("n"), F.sum("words").alias("w"))
    totals = totals.select(
        F.col("_s").alias("_ts"), F.col("pass").alias("_tp"), F.col("_stretch").alias("_tx"),
        (F.sum("n").over(along) - F.col("n")).alias("_n_before"), (F.sum("w").over(along) - F.col("w")).alias("_w_before"),
    )
    placed = local.join(totals, same_key(local["_s"], totals["_ts"]) & same_key(local["pass"], totals["_tp"]) & same_key(local["_stretch"], totals["_tx"]))
    before = F.col("pass") * F.col("source_size") + F.col("_w_before") + F.col("before")
    return placed.withColumn("_left", F.col("wanted") - before).filter("_left > 0").select(
        "_s",
        (F.col("pass") * F.col("blocks") + F.col("_n_before") + F.col("number") - 1).alias("number"),
        *KEY, "copy", "block", F.least("words", "_left").cast("long").alias("words"),
    )


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST_PASSES,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = SEED,
) -> Mix:
    """The blocks of the mix: ``shard, place, doc_id, source, doc_print, copy, first_word, n_words``.

    A block is words `first_word` (from 0) to `first_word + n_words` of a document. `place` is its
    shuffled place in its shard. Copies of a document are told apart by `copy`.
    """
    units = documents(docs, id_column, text_column, source_column)
    sources = written(targets(units, weights, most), "targets")
    blocks = written(permuted_blocks(units, sources, seed), "blocks")
    quotas = written(blocks.groupBy("_s").agg(F.count("*").alias("q")), "quotas")
    total = quotas.agg(F.coalesce(F.sum("q"), F.lit(0)).alias("n")).first().n
    shards = max(1, -(-total // shard_blocks))
    dealt = split_quotas(quotas, shards, shard_blocks, seed)
    ranges = dealt.select("shard", F.explode("quotas").alias("x")).select("shard", F.col("x.s").alias("_s"), F.col("x.q").alias("q"))
    along = Window.partitionBy("_s").orderBy("shard")
    ranges = ranges.withColumn("first", F.sum("q").over(along) - F.col("q"))
    slots = ranges.select(
        "shard", F.col("_s").alias("_slot_s"), F.explode(F.sequence(F.col("first"), F.col("first") + F.col("q") - 1)).alias("_slot")
    )
    # Spark takes the exploded side for as small as its file, and would broadcast it.
    drawn = blocks.join(slots.hint("merge"), (blocks["_s"] == slots["_slot_s"]) & (blocks["number"] == slots["_slot"]))
    shuffled = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), F.lit("place"), "_s", "number"), "_s", "number")
    drawn = drawn.select(
        "shard",
        (F.row_number().over(shuffled) - 1).cast("long").alias("place"),
        F.col("_id").alias("doc_id"),
        F.col("_source").alias("source"),
        F.col("_print").alias("doc_print"),
        F.col("_size").alias("size"),
        "copy",
        (F.col("block") * BLOCK_WORDS).alias("first_word"),
        F.col("words").alias("n_words"),
    )
    return Mix(drawn, units, sources)


def report(mixed: Mix) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document; copies have rows of their own."""
    key = ["doc_id", "source", "doc_print", "size", "copy"]
    taken = mixed.drawn.groupBy(*key).agg(F.sum("n_words").alias("taken")).withColumnsRenamed({c: f"_{c}" for c in key})
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)).alias("copy")
    rows = mixed.units.select(*[F.col(k).alias(c) for k, c in zip(KEY, key)], each)
    on = same_key(rows["doc_id"], F.col("_doc_id"))
    for c in key[1:]:
        on = on & same_key(rows[c], F.col(f"_{c}"))
    rows = rows.join(taken, on, "left").select("doc_id", "source", "size", F.coalesce("taken", F.lit(0)).alias("taken"))
    known = mixed.sources.select(F.col("_source"), "source_size", "target")
    return rows.join(known, same_key(rows["source"], known["_source"])).select("doc_id", "size", "source_size", "target", "taken")
