"""Removal of repeated byte strings by prefix-free parsing.

A byte of a document goes if a string of ``LENGTH`` bytes covers it that also starts in a document
with a smaller ID. The corpus is parsed, not searched:

1. A rolling hash of ``GRAM`` bytes sets triggers: the least hash of each window of ``LENGTH``
   bytes. All windows with one trigger make a phrase. Triggers follow from content only and every
   window has one, so equal windows lie in phrases of the same trigger, at the same offset.
2. Parse: equal phrases meet, and each phrase learns its smallest document. Whatever phrase came
   in an earlier document goes as a whole; in repetitive text that is nearly everything.
3. Dictionary: distinct phrases of one trigger that differ (at the ends of repeats) meet once
   each. The suffixes of these phrases that start a window are put in suffix order, as far as
   ``LENGTH`` bytes, and equal neighbours tell which windows came in an earlier document.
4. Both answers go back to the texts, which are parsed again and cut.

Texts are kept in compressed packs in the shared folder; only phrase digests, the few phrases of
step 3 and packs are shuffled. Phrases are dealt to buckets by trigger, and the number of buckets
grows with the bytes; a pack reports an equal phrase once, however many of its documents hold it.
What passes between packs and buckets is one row for each two that meet. Their number is that of packs
times that of buckets, so both are large, and a row costs a few slices: the work goes with the phrases.
Step 2 compares digests (48 bits of the phrase, 48 of its trigger, per bucket), step 3 bytes.

IDs are integers; a null one counts as larger than all others. Rows of the same ID never remove
from each other. Null and empty texts, and those shorter than a window, stay as they are. An empty
table gives an empty result. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from recordflow.llm.common import written
from recordflow.operators.joins import same_key

LENGTH = 50
GRAM = 20
PACK_BYTES = 8 << 20
PACK_TEXTS = 60_000
BUCKET_BYTES = 16 << 20
BUCKET_ASKED = 1 << 16
LEAST_BUCKETS = 64
PIECE = 1 << 16
LAST = (1 << 63) - 1

U = np.uint64
_PLACES = U((1 << 20) - 1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


_BASE = 0x9E3779B97F4A7C15
_BYTES = _mix(np.arange(1, 257, dtype=U) * U(_BASE))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, U)
    out[0] = 1
    return np.cumprod(out)


class Powers:
    """Powers of the base and of its inverse, made once per worker."""

    up = down = None

    @classmethod
    def get(cls) -> tuple[np.ndarray, np.ndarray]:
        if cls.up is None:
            cls.up = _powers(_BASE, PIECE + LENGTH)
            cls.down = _powers(pow(_BASE, -1, 1 << 64), PIECE + LENGTH)
        return cls.up, cls.down


@dataclass
class Phrases:
    """Phrases of a pack: text number, first and last window start in it, trigger, digests."""

    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    trigger: np.ndarray
    key: np.ndarray  # 48 bits of the phrase's digest, 16 of the trigger's
    group: np.ndarray  # the trigger's digest

    def bucket(self, buckets: int) -> np.ndarray:
        return ((self.group >> U(16)) % U(buckets)).astype(np.int64)


def _rolled(data: np.ndarray) -> np.ndarray:
    """Hash of every ``GRAM`` (20) bytes, from hashes of 2, 4, 8 and 16."""
    h, width, four = _BYTES[data], 1, None
    while width < 16:
        h = h[:-width] * U(pow(_BASE, width, 1 << 64)) + h[width:]
        width *= 2
        four = h if width == 4 else four
    count = len(data) - GRAM + 1
    return _mix(h[:count] * U(pow(_BASE, 4, 1 << 64)) + four[16 : 16 + count])


def _parse_piece(data: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """First and last windows, triggers and digests of the phrases of at most ``PIECE`` windows."""
    grams = _rolled(data)
    least = (grams & ~_PLACES) | np.arange(len(grams), dtype=U)
    span, wide = LENGTH - GRAM + 1, 1
    while wide * 2 <= span:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if wide < span:
        least = np.minimum(least[: len(least) - (span - wide)], least[span - wide :])
    trigger = (least & _PLACES).astype(np.int64)
    inside = owner[: len(trigger)] == owner[LENGTH - 1 :]
    change = trigger[1:] != trigger[:-1]
    first = np.flatnonzero(inside & np.concatenate([[True], change | ~inside[:-1]]))
    last = np.flatnonzero(inside & np.concatenate([change | ~inside[1:], [True]]))
    trigger = trigger[first]
    up, down = Powers.get()
    sums = np.concatenate([np.zeros(1, U), np.cumsum(_BYTES[data] * up[: len(data)])])
    content = (sums[last + LENGTH] - sums[first]) * down[first]
    shape = ((last - first).astype(U) << U(32)) + (trigger - first).astype(U)
    return first, last, trigger, _mix(content + _mix(shape + U(1))), grams[trigger]


def parse(data: np.ndarray, lengths: np.ndarray) -> Phrases:
    """Phrases of texts that lie one behind the other."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    found: list[tuple[np.ndarray, ...]] = []
    at = 0
    while at < len(lengths):
        # As many whole texts as a piece holds; a longer text is cut into overlapping pieces.
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE, side="right")))
        owner = np.repeat(np.arange(at, to), lengths[at:to])
        low, high = int(starts[at]), int(ends[to - 1])
        for a in range(low, high, PIECE):
            b = min(high, a + PIECE + LENGTH - 1)
            if b - a >= LENGTH:
                own = owner[a - low : b - low]
                first, last, trigger, phrase, gram = _parse_piece(data[a:b], own)
                found.append((own[first], first + a, last + a, trigger + a, phrase, gram))
        at = to
    if not found:
        none = np.zeros(0, np.int64)
        return Phrases(none, none, none, none, none.astype(U), none.astype(U))
    text, first, last, trigger, phrase, gram = (np.concatenate(x) for x in zip(*found))
    base = starts[text]
    return Phrases(text, first - base, last - base, trigger - base, (phrase >> U(16)) | (gram & U(0xFFFF)) << U(48), gram)


def packs(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``pack, ids, lengths, bytes, blob``: texts in the order of their IDs, about 8 MB in each row."""
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        held: list[tuple[int, bytes]] = []
        size = 0

        def row() -> pa.RecordBatch:
            held.sort()
            lengths = [len(t) for _, t in held]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([uuid.uuid4().hex]),
                    pa.array([[i for i, _ in held]], pa.list_(pa.int64())),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([sum(lengths)], pa.int64()),
                    pa.array([press.compress(b"".join(t for _, t in held))], pa.binary()),
                ],
                ["pack", "ids", "lengths", "bytes", "blob"],
            )

        for batch in batches:
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                held.append((i, text))
                size += len(text)
                if size >= PACK_BYTES or len(held) >= PACK_TEXTS:
                    yield row()
                    held, size = [], 0
        if held:
            yield row()

    return rows.mapInArrow(pack, "pack string, ids array<long>, lengths array<long>, bytes long, blob binary")


def opened(row: dict) -> tuple[np.ndarray, np.ndarray, Phrases]:
    """IDs, bytes and phrases of a pack."""
    raw = zstandard.ZstdDecompressor().decompress(row["blob"], max_output_size=max(1, row["bytes"]))
    data, lengths = np.frombuffer(raw, np.uint8), np.array(row["lengths"], np.int64)
    return np.array(row["ids"], np.int64), data, parse(data, lengths)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One pack at a time, so that no two are held as Python objects."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _parts(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each bucket with the places of its entries, which are in order of their buckets."""
    cuts = np.flatnonzero(_first_of(bucket)).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(bucket)]):
        yield int(bucket[a]), slice(a, b)


def _distinct(found: Phrases, at: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the phrases `at`, the first of each that are equal, in order of their buckets; the buckets."""
    bucket = found.bucket(buckets)[at]
    order = np.lexsort((found.text[at], found.key[at], bucket))
    at, bucket = at[order], bucket[order]
    head = _first_of(found.key[at]) | _first_of(bucket)
    return at[head], bucket[head]


def _planes(values: np.ndarray) -> bytes:
    """Bytes of like weight side by side: in numbers of like size most of them are the same, and compress."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def _joined(rows: list[dict], name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(r[name] for r in rows), kind)


def _of_packs(pack: np.ndarray, chosen: np.ndarray, packs: int, *values: np.ndarray) -> list[list[bytes]]:
    """For each of the `values`, what is chosen of each pack."""
    at = np.flatnonzero(chosen)
    at = at[np.argsort(pack[at], kind="stable")]
    cuts = np.searchsorted(pack[at], np.arange(packs + 1)).tolist()
    return [[v[a:b].tobytes() for a, b in zip(cuts, cuts[1:])] for v in (v[at] for v in values)]


def _first_of(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else np.zeros(0, bool)


def _rows(names: list[str], types: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)


def digests(table: DataFrame, buckets: int) -> DataFrame:
    """``bucket, pack, keys, groups, docs``: a pack's distinct phrases with their first document."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "pack", "keys", "groups", "docs"]
        types = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
        for row in _each(batches):
            ids, _, found = opened(row)
            at, bucket = _distinct(found, np.arange(len(found.key)), buckets)
            key, doc = found.key[at], ids[found.text[at]]
            group = (((found.group[at] >> U(48)) ^ (found.group[at] >> U(32))) & U(0xFFFF)).astype(np.uint16)
            yield _rows(names, types, [
                (number, row["pack"], key[part].tobytes(), group[part].tobytes(), _planes(doc[part])) for number, part in _parts(bucket)
            ])

    return table.mapInArrow(digest, "bucket long, pack string, keys binary, groups binary, docs binary")


def met(rows: list[dict]) -> list[tuple[str, bytes, bytes]]:
    """Of one bucket: for each pack, the phrases that came earlier, and those for the dictionary.

    `rows` have ``pack, keys, groups, docs``.
    """
    key, group = _joined(rows, "keys", U), _joined(rows, "groups", np.uint16)
    doc = np.concatenate([_numbers(r["docs"]) for r in rows])
    pack = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r["groups"]) // 2 for r in rows])
    # The first bits of a key are the trigger's, so its phrases lie together.
    order = np.lexsort((doc, key, group))
    key, group, doc, pack = key[order], group[order], doc[order], pack[order]
    phrase_start = _first_of(key) | _first_of(group)
    phrase = np.cumsum(phrase_start) - 1
    least = doc[phrase_start]
    earlier = least[phrase] < doc
    # Triggers of several phrases that don't all begin in one document.
    trigger_start = _first_of(key[phrase_start] >> U(48)) | _first_of(group[phrase_start])
    trigger = np.cumsum(trigger_start) - 1
    starts = np.flatnonzero(trigger_start)
    mixed = np.minimum.reduceat(least, starts) < np.maximum.reduceat(least, starts)
    # All packs with the smallest ID are asked: rows of one ID may lie in several.
    looked = (doc == least[phrase]) & mixed[trigger][phrase]
    (gone,), (asked,) = (_of_packs(pack, chosen, len(rows), key) for chosen in (earlier, looked))
    return [(row["pack"], *both) for row, *both in zip(rows, gone, asked) if any(both)]


def _grouped(table: DataFrame, work, names: list[str], types: list[pa.DataType], schema: str, columns: list[str]) -> DataFrame:
    """Apply `work` to the list of rows of each bucket."""

    def run(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_rows(names, types, work(group.to_pylist()))])

    return table.select("bucket", *columns).groupBy("bucket").applyInArrow(run, schema)


def contexts(table: DataFrame, buckets: int) -> DataFrame:
    """``bucket, pack, keys, shapes, bytes``: the phrases that the dictionary asks for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "pack", "keys", "docs", "sizes", "content"]
        types = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        for row in _each(batches):
            asked = np.concatenate([np.frombuffer(a, U) for a in row["asked"]])
            ids, data, found = opened(row)
            at, bucket = _distinct(found, np.flatnonzero(np.isin(found.key, asked)), buckets)
            key, doc = found.key[at], ids[found.text[at]]
            low = (np.cumsum(row["lengths"]) - row["lengths"])[found.text[at]] + found.first[at]
            sizes = found.last[at] - found.first[at] + LENGTH
            out = []
            for number, part in _parts(bucket):
                size = sizes[part]
                content = data[np.repeat(low[part] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
                out.append((number, row["pack"], key[part].tobytes(), _planes(doc[part]), size.astype(np.uint8).tobytes(), content.tobytes()))
            yield _rows(names, types, out)

    return table.mapInArrow(cut, "bucket long, pack string, keys binary, docs binary, sizes binary, content binary")


def suffix_order(data: np.ndarray, starts: np.ndarray, depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of some suffixes of `data`, as far as `depth` bytes, and which equal the one before."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = []
    for at in range(0, depth, 8):
        take = min(8, depth - at)
        word = np.zeros(len(starts), U)
        for k in range(take):
            word = word << U(8) | padded[starts + at + k].astype(U)
        words.append(word)
    order = np.lexsort(words[::-1])
    same = np.zeros(len(starts), bool)
    same[1:] = np.logical_and.reduce([w[order][1:] == w[order][:-1] for w in words])
    return order, same


def dictionary(rows: list[dict]) -> list[tuple[str, bytes, bytes]]:
    """Of one bucket: for each pack, its phrases with windows that came earlier, as bit masks."""
    key, data = _joined(rows, "keys", U), _joined(rows, "content", np.uint8)
    doc = np.concatenate([_numbers(r["docs"]) for r in rows])
    sizes = _joined(rows, "sizes", np.uint8).astype(np.int64)
    pack = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r["sizes"]) for r in rows])
    windows = sizes - LENGTH + 1
    phrase = np.repeat(np.arange(len(key)), windows)
    offset = np.arange(len(phrase)) - np.repeat(np.cumsum(windows) - windows, windows)
    order, same = suffix_order(data, (np.cumsum(sizes) - sizes)[phrase] + offset)
    run = np.cumsum(~same) - 1
    of = doc[phrase[order]]
    least = np.minimum.reduceat(of, np.flatnonzero(~same))
    gone = order[of > least[run]]
    masks = np.zeros(len(key), np.uint32)
    np.bitwise_or.at(masks, phrase[gone], np.uint32(1) << offset[gone].astype(np.uint32))
    masked, marks = _of_packs(pack, masks > 0, len(rows), key, masks)
    return [(row["pack"], *both) for row, *both in zip(rows, masked, marks) if any(both)]


def removed(ids: np.ndarray, lengths: np.ndarray, found: Phrases, gone: np.ndarray, masked: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Which bytes of a pack go."""
    starts = np.cumsum(lengths) - lengths
    edges = np.zeros(int(lengths.sum()) + 1, np.int32)
    # A phrase that an earlier text of the same pack holds goes as well; so the first is to be known.
    order = np.lexsort((found.text, found.key))
    head = _first_of(found.key[order])
    first_id = np.empty(len(order), np.int64)
    first_id[order] = ids[found.text[order]][head][np.cumsum(head) - 1]
    own = ids[found.text]
    whole = np.isin(found.key, gone) | (first_id < own)
    low = starts[found.text] + found.first
    np.add.at(edges, low[whole], 1)
    np.add.at(edges, low[whole] + found.last[whole] - found.first[whole] + LENGTH, -1)
    if len(masked):
        by = np.argsort(masked)
        at = np.minimum(np.searchsorted(masked[by], found.key), len(masked) - 1)
        part = np.flatnonzero((masked[by][at] == found.key) & ~whole)
        bits = masks[by][at[part]]
        for k in range(LENGTH - GRAM + 1):
            hit = low[part[(bits >> np.uint32(k)) & np.uint32(1) == 1]] + k
            np.add.at(edges, hit, 1)
            np.add.at(edges, hit + LENGTH, -1)
    return np.cumsum(edges, dtype=np.int32)[:-1] > 0


def dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep_bytes: bool = True) -> DataFrame:
    """``doc_id, n_bytes, spans, kept_sha256`` and, if asked for, ``kept`` (bytes) of every document.

    ``spans`` are the longest runs of removed bytes, ``start`` included, ``stop`` not.
    """
    table = written(packs(docs, id_column, text_column), "packs")
    total = table.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_BYTES))

    answers = written(
        _grouped(
            digests(table, buckets), met, ["of", "gone", "asked"], [pa.string(), pa.binary(), pa.binary()],
            "of string, gone binary, asked binary", ["pack", "keys", "groups", "docs"],
        ),
        "phrases",
    )
    n_asked = (answers.agg(F.sum(F.octet_length("asked").cast("long"))).first()[0] or 0) // 8
    asked = answers.filter(F.octet_length("asked") > 0).groupBy("of").agg(F.collect_list("asked").alias("asked"))
    wanted = table.join(asked, same_key(table["pack"], asked["of"])).drop("of")
    windows = written(
        _grouped(
            contexts(wanted, max(LEAST_BUCKETS, -(-n_asked // BUCKET_ASKED))), dictionary, ["of", "masked", "masks"], [pa.string(), pa.binary(), pa.binary()],
            "of string, masked binary, masks binary", ["pack", "keys", "docs", "sizes", "content"],
        ),
        "windows",
    )
    empty = F.lit(b"")
    every = (
        answers.filter(F.octet_length("gone") > 0)
        .select("of", "gone", empty.alias("masked"), empty.alias("masks"))
        .unionByName(windows.select("of", empty.alias("gone"), "masked", "masks"))
        .groupBy("of")
        .agg(F.collect_list(F.struct("gone", "masked", "masks")).alias("answers"))
    )
    final = table.join(every, same_key(table["pack"], every["of"]), "left").drop("of")
    types = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.string(), pa.binary()]
    names = ["doc_id", "n_bytes", "spans", "kept_sha256", "kept"][: 5 if keep_bytes else 4]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            ids, data, found = opened(row)
            lengths, own = np.array(row["lengths"], np.int64), row["answers"] or []
            join = lambda name, kind: np.concatenate([np.zeros(0, kind), *[np.frombuffer(a[name], kind) for a in own]])
            flags = removed(ids, lengths, found, join("gone", U), join("masked", U), join("masks", np.uint32))
            out, at = [], 0
            for i, n in zip(ids.tolist(), lengths.tolist()):
                flag, text = flags[at : at + n], data[at : at + n]
                edge = np.flatnonzero(np.diff(np.concatenate([[False], flag, [False]])))
                kept = text[~flag].tobytes() if len(edge) else text.tobytes()
                spans = [{"start": a, "stop": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
                out.append((None if i == LAST else i, n, spans, hashlib.sha256(kept).hexdigest(), kept)[: len(names)])
                at += n
            yield _rows(names, types, out)

    schema = "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept_sha256 string"
    return final.mapInArrow(cut, schema + (", kept binary" if keep_bytes else ""))


def report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every document's numbers of bytes, of removed bytes and runs, and a digest of what stays."""
    done = dedup(docs, id_column, text_column, keep_bytes=False)
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    return done.select(
        "doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )
