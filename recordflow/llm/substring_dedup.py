"""Substring dedup by hashed runs of units: the earliest occurrence of a repeated run stays, others go.

A unit is a sentence, or the rest of a line, in which case and the amount of white space do not
count. A few words repeat by chance, so what is compared are runs of consecutive units with at
least ``MIN_WORDS`` words: a unit goes if any such run it stands in occurred before, wherever the
run begins or ends. It is enough to group the shortest runs from each unit onwards and up to each
unit: a longer one that repeats is covered by them. A text with fewer words is one run, compared
with whole texts only. In scripts written without spaces two characters count as a word.

Runs are grouped by digest over all documents; the earliest is that of the smallest document ID
(null last), then of the smallest place. Within a document a run that overlaps its earliest
occurrence doesn't repeat it. The original offsets of the units that go are kept, in characters.

Null and empty texts have no units, and blank lines between units stay. Rows that repeat ID and
text are one document and each get its result; repeated units within one document count like any
others. An empty table gives an empty result. Columns of the results' names are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from recordflow.llm.common import attach, keyed
from recordflow.operators.joins import same_key

MIN_WORDS = 6
PRINT_CHARS = 16  # 64 bits, a number, tell apart the texts of one ID; every run carries them
OUT_ROWS = 20_000  # runs handed over at a time; bounds a worker's memory
UNIT = regex.compile(r"[^\n.!?]*[.!?]+[^\S\n]*\n?|[^\n.!?]+\n?|\n")
UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")


def size(words: list[str]) -> int:
    """Number of words; of those in a script without spaces, by their length."""
    return sum(1 if w.isascii() else max(1, len(UNSPACED.findall(w)) // 2) for w in words)


def digests(text: str, min_words: int = MIN_WORDS) -> Iterator[tuple[int, int, bytes]]:
    """Start, end and digest of each run of units to compare, in order."""
    spans, normal, upto = [], [], [0]
    for unit in UNIT.finditer(text):
        words = unit[0].lower().split()
        if words:
            spans.append(unit.span())
            normal.append(" ".join(words))
            upto.append(upto[-1] + (len(words) if normal[-1].isascii() else size(words)))
    n = len(spans)
    if n and upto[n] < min_words:
        whole = hashlib.blake2b("\n".join(normal).encode(), digest_size=12, person=b"text")
        yield spans[0][0], spans[-1][1], whole.digest()
        return
    runs = set()
    last = 0
    for first in range(n):  # the shortest from each unit onwards
        while last < n and upto[last + 1] - upto[first] < min_words:
            last += 1
        if last == n:
            break
        runs.add((first, last))
    first = 0
    for last in range(n):  # and up to each unit
        while first < last and upto[last + 1] - upto[first + 1] >= min_words:
            first += 1
        if upto[last + 1] - upto[first] >= min_words:
            runs.add((first, last))
    for first, last in sorted(runs):
        text_of = "\n".join(normal[first : last + 1]).encode()
        yield spans[first][0], spans[last][1], hashlib.blake2b(text_of, digest_size=12).digest()


def _number(print_: Column) -> Column:
    """16 hexadecimal digits as a signed number; ``hex`` turns it back."""
    high, low = (F.conv(F.substring(print_, at, 8), 16, 10).cast("long") for at in (1, 9))
    return F.shiftleft(high, 32).bitwiseOR(low)


def units(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``_id, _print, start, stop, digest`` of every run of units to compare; prints are cut to a number."""
    docs = keyed(docs, id_column, text_column).withColumn("_print", _number(F.substring("_print", 1, PRINT_CHARS)))
    kind = docs.schema["_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, stops, found = [], [], [], []

            def gathered() -> pa.RecordBatch:
                of = pa.array(rows, pa.int32())
                return pa.RecordBatch.from_arrays(
                    [batch.column("_id").take(of), batch.column("_print").take(of), pa.array(starts, pa.int32()), pa.array(stops, pa.int32()), pa.array(found, pa.binary())],
                    ["_id", "_print", "start", "stop", "digest"],
                )

            for row, text in enumerate(batch.column("_text")):
                for start, stop, digest in digests(text.as_py(), min_words):
                    rows.append(row)
                    starts.append(start)
                    stops.append(stop)
                    found.append(digest)
                if len(rows) >= OUT_ROWS:
                    yield gathered()
                    rows, starts, stops, found = [], [], [], []
            yield gathered()

    return docs.mapInArrow(cut, f"_id {kind}, _print long, start int, stop int, digest binary")


def repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``_id, _print, runs``: the offsets, in order, of the runs that repeat an earlier one.

    The earliest places are found by an aggregate with a map-side part and joined back, so a run
    of a third of all rows is neither gathered nor windowed; the join splits it.
    """
    found = units(docs, id_column, text_column, min_words)
    place = F.struct(
        F.col("_id").isNull().alias("last"), F.col("_id").alias("id"), F.col("start").alias("start"), F.col("stop").alias("stop"), F.col("_print").alias("doc")
    )
    first = (
        found.groupBy(F.col("digest").alias("first_digest"))
        .agg(F.min(place).alias("first"), F.count("*").alias("times"))
        .filter("times > 1")
        .select("first_digest", "first")
    )
    same_text = F.col("_id").eqNullSafe(F.col("first.id")) & (F.col("_print") == F.col("first.doc"))
    later = found.join(first, same_key(found["digest"], first["first_digest"])).filter(
        (place > F.col("first")) & ~(same_text & (F.col("start") < F.col("first.stop")))
    )
    return (
        later.groupBy("_id", "_print")
        .agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("runs"))
        .withColumn("_print", F.lpad(F.lower(F.hex("_print")), PRINT_CHARS, "0"))
    )


def within(text: str, runs) -> list[tuple[int, int]]:
    """Start and end of the units, other than blank ones, that lie in the runs, given in order."""
    found, at, stop = [], 0, 0
    for unit in UNIT.finditer(text):
        while at < len(runs) and runs[at][0] <= unit.start():
            stop = max(stop, runs[at][1])
            at += 1
        if unit.end() <= stop and unit[0].strip():
            found.append(unit.span())
    return found


_OFFSETS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))


@F.pandas_udf(_OFFSETS)
def _spans(texts: pd.Series, runs: pd.Series) -> pd.Series:
    def spans(text: str | None, found) -> list[dict] | None:
        if text is None or found is None:
            return None
        return [{"start": a, "stop": b} for a, b in within(text, [(x["start"], x["stop"]) for x in found])]

    return pd.Series([spans(t, r) for t, r in zip(texts, runs)], dtype=object)


def keep(text: str, spans) -> str:
    """The text without the spans."""
    out, at = [], 0
    for start, stop in spans:
        out.append(text[at:start])
        at = max(at, stop)
    return "".join([*out, text[at:]])


@F.pandas_udf(T.StringType())
def _kept(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([t if t is None or s is None else keep(t, [(x["start"], x["stop"]) for x in s]) for t, s in zip(texts, spans)], dtype=object)


def dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS, spans_column: str = "removed_spans") -> DataFrame:
    """`docs` without repeated units, and the original offsets of what was removed."""
    runs = repeats(docs, id_column, text_column, min_words).withColumnRenamed("runs", spans_column)
    found = attach(docs, runs, id_column, text_column, PRINT_CHARS).withColumn(spans_column, _spans(F.col(text_column), F.col(spans_column)))
    return found.withColumn(text_column, _kept(F.col(text_column), F.col(spans_column)))


def report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Every document's removed offsets, ``start-stop`` with commas, and a digest of what stays."""
    plain = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.length(F.coalesce(F.col(text_column), F.lit(""))).cast("long").alias("n_chars"))
    done = dedup(plain, "doc_id", "text", min_words)
    kept = F.coalesce("text", F.lit(""))
    spans = F.coalesce("removed_spans", F.expr("cast(array() as array<struct<start:int,stop:int>>)"))
    return done.select(
        "doc_id",
        "n_chars",
        F.size(spans).cast("long").alias("n_removed_units"),
        (F.col("n_chars") - F.length(kept)).cast("long").alias("n_removed_chars"),
        F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string"))), ",").alias("removed_spans"),
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"),
    )
