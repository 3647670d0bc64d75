"""N-gram Jaccard join by MinHash bands, verified on full n-gram sets.

Words are lower-cased; a text's set holds its windows of ``WORDS`` words, as 64-bit hashes (a
text of fewer words, but not none, is one window). The numbers of bands and of rows in a band are
chosen so that a pair at the threshold meets in some band with at least ``RECALL``.

1. Texts of one set are a class; what follows sees one row for each class.
2. Classes are shuffled on their band hashes. In buckets of several, signatures are compared, and
   pairs far below the threshold fall out. What remains is reported as stars, not as pairs, and
   their components are the candidate clusters.
3. The sets of each cluster meet, and every pair in it is verified. Only the number of links of
   each class and stars of linked classes leave the task. Components of these are the groups.

Large buckets and clusters are cut into blocks, and each pair of blocks is a group of its own, of
bounded size: no pair is left out, none is emitted, and a hot bucket is spread over many tasks.

Null and empty texts have no n-grams: they link to nothing and are groups of their own. Null IDs
are kept; a group's ID is the smallest that isn't null. Repeated rows are in one class. Empty
tables give empty results. Columns of the results' names are replaced.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from recordflow.llm.common import LOWER, UPPER, WORD, keyed, written
from recordflow.llm.components import components
from recordflow.operators.joins import same_key

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9995
MAX_HASHES = 100
BLOCK_MEMBERS = 256
BLOCK_GRAMS = 500_000
# Signatures this many standard deviations under the threshold aren't compared further.
DEVIATIONS = 5.0
CACHE_WORDS = 200_000

_LOWER = str.maketrans(UPPER, LOWER)
_FIND = re.compile(WORD).findall


def banding(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows for which the recall needs at most `max_hashes` hashes."""
    for rows in range(max_hashes, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)) if threshold**rows < recall else 1
        if rows * bands <= max_hashes:
            return bands, rows
    raise ValueError(f"a recall of {recall} at {threshold} needs more than {max_hashes} hashes")


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode())
        return value


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def grams(text: str | None, hashes: WordHashes, size: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's windows of words."""
    words = _FIND((text or "").translate(_LOWER))
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    total = np.full(len(h) - width + 1, len(h) if width < size else size, np.uint64)
    for k in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k]
    return np.unique(_mix(total))


def _constants(count: int) -> tuple[np.ndarray, np.ndarray]:
    base = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return _mix(base)[:, None], (_mix(base + np.uint64(1)) | np.uint64(1))[:, None]


def signature(found: np.ndarray, constants: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least of every hash function over the n-grams, its upper half."""
    flip, factor = constants
    least = None
    for at in range(0, len(found), 2_048):
        part = ((found[at : at + 2_048] ^ flip) * factor).min(axis=1)
        least = part if least is None else np.minimum(least, part)
    return (least >> np.uint64(32)).astype(np.uint32)


def signed(docs: DataFrame, id_column: str, text_column: str, size: int, bands: int, rows: int) -> DataFrame:
    """``_id, _print, node, n_grams, signature, bands`` of every document.

    ``node`` is the digest of the set; null where there are no n-grams.
    """
    docs = keyed(docs, id_column, text_column)
    kind = docs.schema["_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, constants = WordHashes(), _constants(bands * rows)
        for batch in batches:
            nodes, counts, signatures, banded = [], [], [], []
            for text in batch.column("_text").to_pylist():
                found = grams(text, hashes, size)
                counts.append(len(found))
                if not len(found):
                    nodes.append(None)
                    signatures.append(None)
                    banded.append(None)
                    continue
                nodes.append(hashlib.blake2b(found.tobytes(), digest_size=16).hexdigest())
                own = signature(found, constants)
                signatures.append(own.tobytes())
                parts = own.reshape(bands, rows)
                banded.append([xxhash.xxh3_64_intdigest(parts[k].tobytes(), k) - (1 << 63) for k in range(bands)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_print"), pa.array(nodes, pa.string()), pa.array(counts, pa.int64()), pa.array(signatures, pa.binary()), pa.array(banded, pa.list_(pa.int64()))],
                ["_id", "_print", "node", "n_grams", "signature", "bands"],
            )

    return docs.mapInArrow(sign, f"_id {kind}, _print string, node string, n_grams long, signature binary, bands array<long>")


def in_blocks(members: DataFrame, node: str, blocks: Column) -> DataFrame:
    """`members` with ``lo, hi, block``: once for every pair of blocks that a member is to be in.

    With one block there is one pair, (0, 0); else all pairs of different blocks.
    """
    dealt = members.withColumn("_blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64(node), F.col("_blocks")).cast("int"))
    others = F.expr("filter(sequence(0, _blocks - 1), k -> k <> block or _blocks = 1)")
    return (
        dealt.withColumn("_other", F.explode_outer(others))
        .withColumns({"lo": F.least("block", "_other"), "hi": F.greatest("block", "_other")})
        .drop("_blocks", "_other")
    )


def _stars(linked: np.ndarray) -> list[int]:
    """The smallest index that each row of a symmetric matrix is connected with."""
    root = list(range(len(linked)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(*np.nonzero(np.triu(linked, 1))):
        a, b = find(int(i)), find(int(j))
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(linked))]


def probable(signatures: list[bytes], least: float) -> list[int]:
    """Stars of the signatures of a bucket that agree in at least a share of `least`."""
    table = np.stack([np.frombuffer(s, np.uint32) for s in signatures])
    same = np.empty((len(table), len(table)), bool)
    for i, row in enumerate(table):
        same[i] = (table == row).mean(axis=1) >= least
    return _stars(same)


def common(sets: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each two sets share."""
    if len(sets) == 2:
        n = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), n], [n, len(sets[1])]])
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, times = np.unique(every, return_inverse=True, return_counts=True)
    several = times[code] > 1
    column = np.cumsum(times > 1)[code[several]] - 1
    owner = owner[several]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4_096):
        a, b = np.searchsorted(column, [at, at + 4_096])
        part = np.zeros((len(sets), 4_096), np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        shared += part @ part.T
    return np.rint(shared).astype(np.int64)


def verified(sets: list[np.ndarray], blocks: list[int], lo: int, hi: int, n_blocks: int, threshold: float) -> tuple[list[int], list[int]]:
    """Numbers of links and stars of the sets of a pair of blocks.

    Pairs of two blocks are counted where they meet; pairs within a block only once.
    """
    shared, sizes, block = common(sets), np.array([len(s) for s in sets]), np.array(blocks)
    linked = shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-9
    np.fill_diagonal(linked, False)
    across = block[:, None] != block[None, :]
    inside_counts = hi <= lo + 1
    own = np.isin(block, [lo] + ([hi] if hi == n_blocks - 1 else [])) if inside_counts else np.zeros(len(block), bool)
    counted = linked & (across | own[:, None])
    return counted.sum(axis=1).tolist(), _stars(linked)


def links(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """Every document with its class, and every class that is linked with its links and group.

    ``_id, _print, node, n_grams`` and ``node, n_links, root``.
    """
    bands, rows = banding(threshold, recall)
    marks = written(signed(docs, id_column, text_column, words, bands, rows), "signatures")
    classes = (
        marks.filter(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.min(F.struct("_id", "_print")).alias("of"), F.first("signature").alias("signature"), F.first("bands").alias("bands"), F.first("n_grams").alias("n_grams"))
    )
    classes = written(classes, "classes")

    members = classes.select("node", F.posexplode_outer("bands").alias("band", "hash"))
    buckets = members.groupBy(F.col("band").alias("b"), F.col("hash").alias("h")).agg(F.count("*").alias("n")).filter("n > 1")
    crowded = members.join(buckets, same_key(members["hash"], buckets["h"]) & same_key(members["band"], buckets["b"])).select("band", "hash", "n", "node")
    dealt = in_blocks(crowded, "node", F.ceil(F.col("n") / BLOCK_MEMBERS))
    with_signature = dealt.join(classes.select(F.col("node").alias("_node"), "signature"), same_key(F.col("node"), F.col("_node")))
    gathered = with_signature.groupBy("band", "hash", "lo", "hi").agg(F.collect_list(F.struct("node", "signature")).alias("members"))
    least = threshold - DEVIATIONS * math.sqrt(threshold * (1 - threshold) / (bands * rows))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for found in batch.column("members").to_pylist():
                roots = probable([m["signature"] for m in found], least)
                for i, root in enumerate(roots):
                    if i != root:
                        left.append(found[i]["node"])
                        right.append(found[root]["node"])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], ["u", "v"])

    clusters = written(components(gathered.select("members").mapInArrow(compare, "u string, v string")), "clusters")

    sized = clusters.join(classes.select(F.col("node").alias("_node"), "of", "n_grams"), same_key(clusters["node"], F.col("_node"))).drop("_node")
    per_cluster = sized.groupBy(F.col("root").alias("_root")).agg(F.count("*").alias("n"), F.sum("n_grams").alias("total"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_MEMBERS), F.ceil(F.col("total") / BLOCK_GRAMS))
    wanted = (
        sized.join(per_cluster, same_key(sized["root"], per_cluster["_root"]))
        .withColumn("n_blocks", F.least(blocks, F.col("n")).cast("int"))
        .select("node", "root", "n_blocks", F.col("of._id").alias("_of"), F.col("of._print").alias("_of_print"))
    )
    texts = keyed(docs, id_column, text_column)
    found = wanted.join(texts, same_key(texts["_print"], wanted["_of_print"]) & same_key(texts["_id"], wanted["_of"]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [grams(t, hashes, words).tobytes() for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sets, pa.binary())], ["node", "root", "n_blocks", "grams"])

    cut_sets = found.select("node", "root", "n_blocks", "_text").mapInArrow(cut, "node string, root string, n_blocks int, grams binary")
    placed = in_blocks(cut_sets, "node", F.col("n_blocks"))
    tasks = placed.groupBy("root", "n_blocks", "lo", "hi").agg(F.collect_list(F.struct("node", "block", "grams")).alias("members"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                one = {m["node"]: m for m in row["members"]}  # repeated rows give a set twice
                found = [one[n] for n in sorted(one)]
                counts, roots = verified(
                    [np.frombuffer(m["grams"], np.uint64) for m in found], [m["block"] for m in found], row["lo"], row["hi"], row["n_blocks"], threshold
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m["node"] for m in found], pa.string()), pa.array(counts, pa.int64()), pa.array([found[r]["node"] for r in roots], pa.string())],
                    ["node", "n_links", "star"],
                )

    stars = written(tasks.mapInArrow(verify, "node string, n_links long, star string"), "links")
    groups = components(stars.select("node", "star"))
    counts = stars.groupBy("node").agg(F.sum("n_links").alias("n_links")).filter("n_links > 0")
    linked = counts.join(groups.select(F.col("node").alias("_node"), "root"), same_key(counts["node"], F.col("_node"))).drop("_node")
    return marks.select("_id", "_print", "node", "n_grams"), linked


def report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``doc_id, class_id, copy_id, n_links, n_grams`` of every document.

    ``class_id`` is the smallest ID among all that links or equal sets connect, ``copy_id`` that
    among documents of the same set, ``n_links`` the number of other sets linked with this one.
    """
    marks, linked = links(docs, id_column, text_column, **options)
    linked = written(linked, "linked")
    copies = marks.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("_id").alias("copy_id"))
    known = copies.join(linked.withColumnRenamed("node", "_node"), same_key(copies["node"], F.col("_node")), "left").drop("_node")
    known = written(known.withColumn("root", F.coalesce("root", "node")), "groups")
    firsts = known.groupBy(F.col("root").alias("_root")).agg(F.min("copy_id").alias("class_id"))
    nodes = known.join(firsts, same_key(known["root"], firsts["_root"])).select(F.col("node").alias("_node"), "copy_id", "class_id", "n_links")
    return marks.join(nodes, same_key(marks["node"], nodes["_node"]), "left").select(
        F.col("_id").alias("doc_id"),
        F.coalesce("class_id", "_id").alias("class_id"),
        F.coalesce("copy_id", "_id").alias("copy_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        "n_grams",
        "_print",
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """`docs` with one document of each group: that of the smallest ID.

    Documents without n-grams stay. Rows that repeat the ID and text of one that stays do too; of a
    group without any ID, all rows stay.
    """
    found = report(docs, id_column, text_column, **options)
    gone = found.filter(~F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.col("doc_id").alias("_gone"), F.col("_print").alias("_gone_print")).distinct()
    print_of = F.md5(F.coalesce(docs[text_column], F.lit("")).cast("binary"))
    return docs.join(gone, same_key(print_of, gone["_gone_print"]) & same_key(docs[id_column], gone["_gone"]), "left_anti")
