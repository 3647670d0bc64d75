"""Best-fit packing of documents into bins of a fixed number of words, under conflicts.

Documents of one source, or of one cluster of duplicates, may not share a bin. Open bins are kept
in the order of what is left in them; each carries bitmaps of its sources and clusters. A piece
goes to the first bin, from the tightest that holds it upwards, whose bitmaps it doesn't meet;
if there is none, it opens a bin. Longer pieces come first.

A document longer than a bin is cut: whole bins first, then the rest. Documents are dealt by a
hash to shards of about ``SHARD_ROWS`` documents, so the number of tasks grows with the input
and a hot source or a large cluster is spread evenly over all of them.

The size of a text is its number of words between white space. By default a cluster is the
documents whose words are the same but for case; a column may name it instead. Null and empty
texts have one piece of no words. A null source or a null cluster is in conflict with nothing.
Repeated rows are pieces of their own. An empty table gives no bins.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

CAPACITY = 2_048
SHARD_ROWS = 4_096

Piece = tuple[int, int, int]  # size, source bit, cluster bit; -1: in conflict with nothing


def best_fit(pieces: Iterable[Piece], capacity: int = CAPACITY) -> list[int]:
    """The bin, from 0, of each piece, in the order given."""
    left: list[tuple[int, int]] = []
    sources: list[int] = []
    clusters: list[int] = []
    placed = []
    for size, source, cluster in pieces:
        source_bit = 1 << source if source >= 0 else 0
        cluster_bit = 1 << cluster if cluster >= 0 else 0
        at = bisect_left(left, (size, -1))
        while at < len(left):
            number = left[at][1]
            if not (sources[number] & source_bit or clusters[number] & cluster_bit):
                break
            at += 1
        if at < len(left):
            rest, number = left.pop(at)
            sources[number] |= source_bit
            clusters[number] |= cluster_bit
        else:
            rest, number = capacity, len(sources)
            sources.append(source_bit)
            clusters.append(cluster_bit)
        insort(left, (rest - size, number))
        placed.append(number)
    return placed


def _bits(values: pd.Series, only_repeated: bool = False) -> list[int]:
    """Small numbers for values; -1 for nulls and, where asked, for values that come once."""
    codes, _ = pd.factorize(values, use_na_sentinel=True)
    if not only_repeated:
        return codes.tolist()
    times = pd.Series(codes).map(pd.Series(codes).value_counts())
    repeated, _ = pd.factorize(pd.Series(codes).where((times > 1) & (codes >= 0)), use_na_sentinel=True)
    return repeated.tolist()


def pack_shard(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Pieces of the documents of one shard (``_id, _size, _source, _cluster``), with their bins."""
    rows = rows.sort_values(["_id", "_cluster", "_source"], kind="stable").reset_index(drop=True)
    sources, clusters = _bits(rows["_source"]), _bits(rows["_cluster"], only_repeated=True)
    sizes = rows["_size"].tolist()
    # Whole bins hold one piece only; the rests are packed, longest first.
    whole = [max(0, n - 1) // capacity for n in sizes]
    rest = [n - k * capacity for n, k in zip(sizes, whole)]
    order = sorted(range(len(sizes)), key=lambda i: (-rest[i], i))
    bins = dict(zip(order, best_fit([(rest[i], sources[i], clusters[i]) for i in order], capacity)))
    number = max(bins.values(), default=-1) + 1
    out = []
    for i, n in enumerate(sizes):
        for piece in range(whole[i]):
            out.append((number, i, piece, piece * capacity, capacity))
            number += 1
        out.append((bins[i], i, whole[i], whole[i] * capacity, rest[i]))
    found = pd.DataFrame(out, columns=["bin", "row", "piece", "start", "n_words"])
    picked = rows.loc[found["row"]].reset_index(drop=True)
    return found.assign(_id=picked["_id"], _source=picked["_source"], _cluster=picked["_cluster"])


def sized(docs: DataFrame, id_column: str, text_column: str, source_column: str | None, cluster_column: str | None) -> DataFrame:
    """``_id, _size, _source, _cluster`` of every document; texts end here."""

    @F.pandas_udf("struct<size:bigint,cluster:string>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                words = (text or "").lower().split()
                rows.append((len(words), hashlib.blake2b(" ".join(words).encode(), digest_size=16).hexdigest() if words else None))
            yield pd.DataFrame(rows, columns=["size", "cluster"])

    source = F.col(source_column).cast("string") if source_column else F.lit(None).cast("string")
    measured = docs.select(
        F.col(id_column).alias("_id"),
        source.alias("_source"),
        *([F.col(cluster_column).cast("string").alias("_named")] if cluster_column else []),
        measure(F.col(text_column)).alias("_m"),
    )
    cluster = F.col("_named") if cluster_column else F.col("_m.cluster")
    return measured.select("_id", F.col("_m.size").alias("_size"), "_source", cluster.alias("_cluster"))


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str | None = "source",
    cluster_column: str | None = None,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``bin_id, doc_id, piece, start, n_words, source``: every piece of every document once.

    ``start`` and ``n_words`` are the piece's place in the words of its document.
    """
    shards = max(1, -(-docs.count() // shard_rows))
    rows = sized(docs, id_column, text_column, source_column, cluster_column)
    dealt = rows.withColumn("_shard", F.pmod(F.xxhash64("_id", "_cluster", "_source"), F.lit(shards)).cast("int"))
    kind = rows.schema["_id"].dataType.simpleString()

    def packed(key: tuple[int], part: pd.DataFrame) -> pd.DataFrame:
        found = pack_shard(part, capacity)
        return pd.DataFrame(
            {
                "bin_id": (int(key[0]) << 32) + found["bin"],
                "doc_id": found["_id"],
                "piece": found["piece"],
                "start": found["start"],
                "n_words": found["n_words"],
                "source": found["_source"],
            }
        )

    schema = f"bin_id long, doc_id {kind}, piece long, start long, n_words long, source string"
    return dealt.groupBy("_shard").applyInPandas(packed, schema)
