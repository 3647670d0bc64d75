"""A trie of conversations, by collapsing whole sequences of turns.

Each conversation is rebuilt from another one's opening and its own rest. Identical rebuilt
conversations collapse into one weighted sequence with the list of those that end there. A
sequence that is a proper prefix of another is no leaf: an anti-join against all proper prefixes
finds the leaves. Only one conversation of each sequence is then spread into its prefixes, and the
weighted prefixes are aggregated to nodes.

A node's key is the exclusive or of two 64-bit hashes of each turn with its place, so all prefixes
of a conversation come from one running aggregate. Running aggregates have two steps, inside
blocks of ``BLOCK`` turns and over the blocks' totals, so a conversation with a third of all turns
is spread over tasks too. A sum over a subtree needs no walk up the trie: each node is counted by
the conversation that names it, from where it stands downwards, and the prefixes of a node's
conversations lie in its subtree from its depth on.

Rows without a conversation ID belong to none and are left out. Null turns come first; turns that
tie follow a digest of role and text. Null roles and texts are empty ones; repeated rows are
turns of their own; an empty table has no nodes, not even a root. Only the four named columns are
read, so others can't clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from recordflow.llm.common import written
from recordflow.operators.joins import same_key

BLOCK = 1_024
# Conversations share the opening of the first of each so many IDs, of fewer turns than HEADS.
FAMILY, HEADS = 20, 4
WORD = r"[^\x20\x09-\x0D]+"
# So many neighbouring IDs of the end of a sequence are one row at most.
ENDS_AT_ONCE = 4_096


def numbered_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv, block, place, turn_md5, words`` of every turn, and ``conv, block, before, length``.

    `place` counts from 1 inside a block of turn numbers; `before` is how many turns of the
    conversation earlier blocks hold, `length` how many it has.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.floor(F.col("turn") / BLOCK).cast("long").alias("block"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("turn_md5"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    inside = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "turn_md5")
    placed = turns.withColumn("place", F.row_number().over(inside).cast("long")).drop("turn")
    blocks = turns.groupBy("conv", "block").agg(F.count("*").alias("n"))
    along = Window.partitionBy("conv").orderBy(F.col("block").asc_nulls_first())
    blocks = blocks.select(
        "conv",
        "block",
        (F.sum("n").over(along) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy("conv")).alias("length"),
    )
    return placed, blocks


def opening_length(conv: Column) -> Column:
    """How many turns a conversation takes over: the checksum of its ID's digits, modulo `HEADS`."""
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv, place, turn_md5, words`` of the rebuilt conversations, and ``conv, length`` of all.

    Conversation c starts with the opening turns of c - c % 20 and goes on with its own turns
    after as many of its first.
    """
    placed, blocks = numbered_turns(turns)
    blocks = written(blocks, "blocks")
    family = (F.col("conv") - F.col("conv") % FAMILY).alias("family")
    convs = blocks.groupBy("conv").agg(F.max("length").alias("length"))
    bases = convs.filter(F.col("conv") % FAMILY == 0).select(F.col("conv").alias("_base"), F.least("length", F.lit(HEADS)).alias("there"))
    convs = convs.select("conv", "length", family, opening_length(F.col("conv")).alias("opening"))
    convs = convs.join(bases, same_key(convs["family"], bases["_base"]), "left").select(
        "conv", "length", "family", "opening", F.least("opening", F.coalesce("there", F.lit(0))).alias("taken")
    )
    convs = written(convs, "conversations")
    shift = blocks.join(convs.drop("length"), "conv").select(
        F.col("conv").alias("_conv"), F.col("block").alias("_block"), "before", "opening", (F.col("taken") - F.col("opening")).alias("shift")
    )
    on = same_key(placed["conv"], shift["_conv"]) & same_key(placed["block"], shift["_block"])
    own = placed.join(shift, on).withColumn("place", F.col("place") + F.col("before")).drop("before", "_conv", "_block", "block")
    own = written(own, "turns")
    heads = own.filter((F.col("conv") % FAMILY == 0) & (F.col("place") < HEADS)).select(
        F.col("conv").alias("_base"), F.col("place").alias("_place"), "turn_md5", "words"
    )
    takers = convs.filter("taken > 0").select("conv", "family", F.explode(F.sequence(F.lit(1), "taken")).alias("place"))
    opened = takers.join(heads, same_key(takers["family"], heads["_base"]) & same_key(takers["place"], heads["_place"]))
    rest = own.filter("place > opening").withColumn("place", F.col("place") + F.col("shift"))
    columns = ["conv", F.col("place").cast("long").alias("place"), "turn_md5", "words"]
    lengths = convs.select("conv", (F.col("taken") + F.greatest(F.col("length") - F.col("opening"), F.lit(0))).alias("length"))
    return opened.select(columns).unionByName(rest.select(columns)), lengths


def running(rows: DataFrame, values: dict[str, Callable[[Column | str], Column]], downwards: bool = False) -> DataFrame:
    """`rows` (``conv, place``, ...) with columns replaced by their running aggregate along a conversation.

    `values`: ``F.sum`` or ``F.bit_xor`` for each column. `downwards`: from the last place to the first.
    """
    rows = rows.withColumn("_block", F.floor(F.col("place") / BLOCK))
    if downwards:
        rows = rows.withColumn("_block", -F.col("_block"))
    order = F.col("place").desc() if downwards else F.col("place").asc()
    inside = Window.partitionBy("conv", "_block").orderBy(order)
    earlier = Window.partitionBy("conv").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv", "_block").agg(*[f(c).alias(c) for c, f in values.items()])
    totals = totals.select(
        F.col("conv").alias("_conv"), F.col("_block").alias("_at"), *[F.coalesce(f(c).over(earlier), F.lit(0)).alias(f"_{c}") for c, f in values.items()]
    )
    # Most conversations have one block: nothing to add, so only those of several are looked up.
    totals = totals.filter(" OR ".join(f"_{c} <> 0" for c in values))
    rows = rows.withColumns({c: f(c).over(inside) for c, f in values.items()})
    joined = rows.join(totals, same_key(rows["conv"], totals["_conv"]) & same_key(rows["_block"], totals["_at"]), "left")
    for c, f in values.items():
        before = F.coalesce(f"_{c}", F.lit(0))
        joined = joined.withColumn(c, F.col(c).bitwiseXOR(before) if f is F.bit_xor else F.col(c) + before)
    return joined.drop("_block", "_conv", "_at", *[f"_{c}" for c in values])


def ends(sequences: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of ``key, conv``: the digest of each key's IDs in order, joined by commas.

    IDs are put together in stretches of neighbours, a row each; the rows of a key then stream
    through one digest in order, so its list is never held anywhere.
    """
    stretch = F.floor(F.col("conv") / ENDS_AT_ONCE).alias("stretch")
    ids = F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string"))
    joined = sequences.groupBy("k1", "k2", "length", stretch).agg(F.array_join(ids, ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for batch in batches:
            for *here, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "length", "ids"))):
                if here == key:
                    state.update(b",")
                else:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = here, sha256()
                state.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(("k1", "k2", "length", "ends_sha256"), d)) for d in done])
                done = []
        if key is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(("k1", "k2", "length", "ends_sha256"), (*key, state.hexdigest())))])

    dealt = joined.repartition("k1", "k2", "length").sortWithinPartitions("k1", "k2", "length", "stretch")
    return dealt.mapInArrow(digest, "k1 long, k2 long, length long, ends_sha256 string")


def _same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of columns with those of `right` named with a leading line."""
    on = same_key(left[names[0]], right[f"_{names[0]}"])
    for name in names[1:]:
        on = on & same_key(left[name], right[f"_{name}"])
    return on


def trie(turns: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns of rebuilt conversations.

    ``conv_id`` (its smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens`` (of its subtree: words of the last turn, for every member but one) and
    ``ends_sha256`` (members that end there).
    """
    found, lengths = rebuilt(turns)
    hashes = {f"h{i}": F.xxhash64("place", "turn_md5", F.lit(i)) for i in (1, 2)}
    hashed = found.select("conv", "place", "words", *[h.alias(n) for n, h in hashes.items()])
    hashed = hashed.withColumns({"k1": F.col("h1"), "k2": F.col("h2")})
    prefixes = written(running(hashed, {"k1": F.bit_xor, "k2": F.bit_xor}), "prefixes")

    # Whole sequences: that of a conversation without turns has the root's key.
    whole = F.max_by(F.struct("k1", "k2"), "place")
    last = prefixes.groupBy("conv").agg(whole.alias("key")).select(F.col("conv").alias("_conv"), "key.*")
    ended = lengths.join(last, same_key(lengths["conv"], last["_conv"]), "left").select(
        "conv", F.col("length").cast("long").alias("length"), F.coalesce("k1", F.lit(0)).alias("k1"), F.coalesce("k2", F.lit(0)).alias("k2")
    )
    ended = written(ended, "ended")
    key = ["k1", "k2", "length"]
    sequences = ended.groupBy(*key).agg(F.count("*").alias("weight"), F.min("conv").alias("conv"))
    sequences = written(sequences, "sequences")
    chosen = sequences.select(F.col("conv").alias("_conv"), "weight", F.col("length").alias("all"))
    spread = prefixes.join(chosen, same_key(prefixes["conv"], F.col("_conv")))
    spread = spread.select("conv", "place", "words", "h1", "h2", "k1", "k2", "weight", "all")
    roots = sequences.select(
        "conv", F.lit(0).cast("long").alias("place"), F.lit(0).cast("long").alias("words"),
        *[F.lit(0).cast("long").alias(c) for c in ("h1", "h2", "k1", "k2")], "weight", F.col("length").alias("all"),
    )
    spread = written(spread.unionByName(roots), "spread")

    # Leaves: sequences that are no proper prefix.
    proper = spread.filter("place < all").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("place").alias("_length")).distinct()
    leaves = sequences.join(proper, _same(sequences, proper, *key), "left_anti").select(F.col("conv").alias("_conv"), F.lit(1).alias("leaf"))

    # Nodes, and what each saves, laid on the prefix of the conversation that names it.
    node = ["k1", "k2", "place"]
    weights = spread.groupBy(*node).agg(F.sum("weight").alias("n"), F.min("conv").alias("_conv"), F.max("words").alias("_words"))
    saved = weights.select("_conv", F.col("place").alias("_place"), ((F.col("n") - 1) * F.col("_words")).alias("saved"))
    owned = spread.join(saved, _same(spread, saved, "conv", "place"), "left").withColumn("saved", F.coalesce("saved", F.lit(0)))
    below = running(owned.drop("_conv", "_place"), {"saved": F.sum}, downwards=True)
    below = below.join(leaves, same_key(below["conv"], leaves["_conv"]), "left")
    nodes = below.groupBy(*node).agg(
        F.min("conv").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.sum(F.coalesce("leaf", F.lit(0))).cast("long").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
        F.max(F.col("k1").bitwiseXOR(F.col("h1"))).alias("up1"),
        F.max(F.col("k2").bitwiseXOR(F.col("h2"))).alias("up2"),
    )
    nodes = written(nodes, "nodes")
    children = nodes.filter("place > 0").groupBy(F.col("up1").alias("_k1"), F.col("up2").alias("_k2"), (F.col("place") - 1).alias("_place"))
    children = children.agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("k1").alias("_up1"), F.col("k2").alias("_up2"), (F.col("place") + 1).alias("_place"), F.col("conv_id").alias("parent_conv_id"))
    listed = ends(ended).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("length").alias("_place"), "ends_sha256")
    out = nodes.join(children, _same(nodes, children, *node), "left").drop("_k1", "_k2", "_place")
    out = out.join(listed, _same(out, listed, *node), "left").drop("_k1", "_k2", "_place")
    out = out.join(parents, _same(out, parents, "up1", "up2", "place"), "left")
    return out.select(
        "conv_id",
        F.col("place").alias("depth"),
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
