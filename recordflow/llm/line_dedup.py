"""Line dedup: align overlapping documents through shared rare lines, delete common blocks.

Every line that occurs in several documents points to the earliest of them. A document and the
earlier one its lines point to are a pair; the pair's lines are aligned by patience diff: lines
that both hold once are matched in their longest common order, and matches grow to equal
neighbours; a line that repeats is compared with all its places. Two neighbouring lines (but for
blank ones) that are neighbours in any earlier document are aligned as well, so a block copied from
a later one than the first holder of its lines is found whole. A run of aligned lines in the later document is a block, whichever earlier documents
its lines come from, and goes if it holds ``MIN_WORDS`` words, in however many documents its lines
are. With `rare_texts` a block must also hold a rare line (in at most so many documents) or
``MIN_LINES`` lines.

A line and a pair of neighbours point to one document each. Thus the work grows with the number of lines, not with the
square of the number of documents that share one, and no list of documents is capped.

Lines are equal if they are after trimming. A blank line never matches, and ends a block. The
earlier document is that of the smaller ID (null last), then of the smaller fingerprint; rows
that repeat ID and text are one document, and each gets its result. Null and empty texts have no
lines and stay as they are. Empty tables give empty results. Columns of the results' names are
replaced.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from recordflow.llm.common import attach, keyed, written
from recordflow.operators.joins import same_key

# No limit: as a count it would delete a line from a small table and keep it in a large one.
RARE_TEXTS = None
MIN_WORDS = 8
MIN_LINES = 3


def _place() -> Column:
    """Orders documents: by ID, null last, then by fingerprint."""
    return F.struct(F.col("_id").isNull().alias("last"), F.col("_id").alias("id"), F.col("_print").alias("fingerprint"))


def lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_id, _print, line_no, digest, n_words, pair`` of every line that isn't blank.

    ``pair`` stands for the line and the next one that isn't blank; null at the end of a text.
    """
    docs = keyed(docs, id_column, text_column)
    full = F.filter(
        F.transform(F.split("_text", "\n", -1), lambda line, i: F.struct(i.alias("line_no"), F.trim(line).alias("line"))), lambda x: x["line"] != ""
    )
    split = docs.select("_id", "_print", full.alias("_lines"))
    with_next = F.zip_with("_lines", F.slice("_lines", 2, 1 << 30), lambda x, y: F.struct(x["line_no"].alias("line_no"), x["line"].alias("line"), y["line"].alias("next")))
    line, following = F.col("_line.line"), F.col("_line.next")
    return (
        split.select("_id", "_print", F.explode(with_next).alias("_line"))
        .select(
            "_id",
            "_print",
            "_line.line_no",
            F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b")).alias("digest"),
            F.regexp_count(line, F.lit(r"\S+")).alias("n_words"),
            F.when(following.isNotNull(), F.xxhash64(F.lit("pair"), line, following)).alias("pair"),
        )
    )


def shared_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Lines of several documents, once a document: ``_id, _print, found`` (places), ``hub, n_texts``.

    ``hub`` is the earliest document with all places of the line there. One aggregate over all
    lines, with a map-side part, finds it; it is joined back so that Spark can split a line of a
    third of all rows.
    """
    per_text = (
        lines(docs, id_column, text_column)
        .groupBy("_id", "_print", "digest")
        .agg(F.collect_set(F.struct("line_no", "n_words", F.coalesce("pair", F.lit(0)).alias("pair"))).alias("found"))
    )
    places = F.array_sort(F.transform("found", lambda x: x["line_no"]))
    known = (
        per_text.groupBy(F.col("digest").alias("_of"))
        .agg(F.min(F.struct(_place().alias("place"), places.alias("lines"))).alias("hub"), F.count("*").alias("n_texts"))
        .filter("n_texts > 1")
    )
    return per_text.join(known, same_key(per_text["digest"], known["_of"])).select("_id", "_print", "found", "hub", "n_texts")


def paired_lines(shared: DataFrame) -> DataFrame:
    """``_id, _print, paired``: lines that an earlier document has with the same line next."""
    pairs = shared.select("_id", "_print", F.explode("found").alias("_found")).filter("_found.pair != 0").select(
        "_id", "_print", F.col("_found.line_no").alias("paired"), F.col("_found.pair").alias("pair")
    )
    known = (
        pairs.groupBy(F.col("pair").alias("_of"))
        .agg(F.min(_place()).alias("holder"), F.max(_place()).alias("final"))
        .filter(F.col("holder") < F.col("final"))
        .select("_of", "holder")
    )
    return pairs.join(known, same_key(pairs["pair"], known["_of"])).filter(_place() > F.col("holder")).select("_id", "_print", "paired")


def patience(later: list[int], earlier: list[int]) -> list[int]:
    """Indices of a longest rising run of `earlier`, given in the order of `later`."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(earlier)
    for i, value in enumerate(earlier):
        k = bisect_left(tails, value)
        before[i] = ends[k - 1] if k else -1
        if k == len(tails):
            tails.append(value)
            ends.append(i)
        else:
            tails[k], ends[k] = value, i
    chain, i = [], ends[-1] if ends else -1
    while i >= 0:
        chain.append(i)
        i = before[i]
    return chain[::-1]


def aligned(rows: list[dict]) -> set[int]:
    """Line numbers of a later document that are aligned with an earlier one.

    `rows`: ``line_no, hub, hub_line, times`` (how often the earlier document has the line); where
    known also ``hub_lines``, all its places there in order, and ``paired``, whether any earlier
    document has it with the same line next.
    """
    found: set[int] = set()
    by_hub: dict[object, list[dict]] = {}
    before = None
    for row in sorted(rows, key=lambda r: r["line_no"]):
        by_hub.setdefault(row["hub"], []).append(row)
        if before and before.get("paired"):
            found.update((before["line_no"], row["line_no"]))
        before = row
    for pair in by_hub.values():
        once = Counter(r["hub_line"] for r in pair)
        unique = [r for r in pair if r["times"] == 1 and once[r["hub_line"]] == 1]
        chain = patience([r["line_no"] for r in unique], [r["hub_line"] for r in unique])
        anchors = [(unique[i]["line_no"], unique[i]["hub_line"]) for i in chain]
        found.update(line for line, _ in anchors)
        # Lines that repeat: between two anchors, or at an end, those of the earlier text in order.
        bounds = [(-1, -1), *anchors, (1 << 31, 1 << 31)]
        taken = {r["line_no"] for r in unique}
        gap = 0
        for r in pair:
            while r["line_no"] > bounds[gap + 1][0]:
                gap += 1
            low, high = bounds[gap][1], bounds[gap + 1][1]
            if r["line_no"] not in taken and (r["times"] > 1 or once[r["hub_line"]] > 1):
                places = r.get("hub_lines", [r["hub_line"]])
                k = bisect_right(places, low)
                if k < len(places) and places[k] < high:
                    found.add(r["line_no"])
    return found


def blocks(rows: list[dict], rare_texts: int | None, min_words: int, min_lines: int) -> list[int]:
    """Line numbers to delete: those of the runs of aligned lines that are large enough."""
    lines_found = aligned(rows)
    gone: list[int] = []
    run: list[dict] = []

    def close() -> None:
        rare = rare_texts is None or any(r["n_texts"] <= rare_texts for r in run)
        if sum(r["n_words"] for r in run) >= min_words and (rare or len(run) >= min_lines):
            gone.extend(r["line_no"] for r in run)

    for r in sorted(rows, key=lambda r: r["line_no"]):
        if r["line_no"] not in lines_found:
            continue
        if run and r["line_no"] != run[-1]["line_no"] + 1:
            close()
            run = []
        run.append(r)
    close()
    return gone


def spread(rows: list[dict], paired: list[int]) -> list[dict]:
    """One row a line, from one row a distinct line."""
    with_next = set(paired)
    return [
        {
            "line_no": x["line_no"],
            "hub": r["hub"],
            "hub_line": r["hub_lines"][0],
            "hub_lines": r["hub_lines"],
            "times": len(r["hub_lines"]),
            "n_texts": r["n_texts"],
            "n_words": x["n_words"],
            "paired": x["line_no"] in with_next,
        }
        for r in rows
        for x in r["found"]
    ]


def deletions(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rare_texts: int | None = RARE_TEXTS,
    min_words: int = MIN_WORDS,
    min_lines: int = MIN_LINES,
) -> DataFrame:
    """``_id, _print, gone``: the line numbers, from 0, that each document loses."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def delete(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for found, paired in batches:
            yield pd.Series([blocks(spread(list(r), list(p)), rare_texts, min_words, min_lines) for r, p in zip(found, paired)], dtype=object)

    # Read three times below, and small: only lines of several documents.
    shared = written(shared_lines(docs, id_column, text_column), "shared-lines")
    row = F.struct("found", F.to_json("hub.place").alias("hub"), F.col("hub.lines").alias("hub_lines"), "n_texts")
    later = shared.filter(_place() > F.col("hub.place")).select("_id", "_print", row.alias("row"))
    # One text's lines: no larger than the text, and the places in earlier ones.
    gathered = (
        later.unionByName(paired_lines(shared), allowMissingColumns=True)
        .groupBy("_id", "_print")
        .agg(F.collect_set("row").alias("rows"), F.collect_set("paired").alias("paired"))
    )
    return gathered.select("_id", "_print", F.array_sort(delete("rows", "paired")).alias("gone")).filter(F.size("gone") > 0)


@F.pandas_udf(T.StringType())
def _remaining(texts: pd.Series, gone: pd.Series) -> pd.Series:
    def keep(text: str | None, numbers) -> str | None:
        if text is None or numbers is None:
            return text
        drop = set(numbers)
        return "\n".join(line for k, line in enumerate(text.split("\n")) if k not in drop)

    return pd.Series([keep(t, g) for t, g in zip(texts, gone)], dtype=object)


def dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", gone_column: str | None = None, **options) -> DataFrame:
    """`docs` without the deleted lines; `gone_column` names their numbers in the original text."""
    gone = deletions(docs, id_column, text_column, **options).withColumnRenamed("gone", gone_column or "_gone")
    name = gone_column or "_gone"
    marked = attach(docs, gone, id_column, text_column)
    out = marked.withColumn(text_column, _remaining(F.col(text_column), F.col(name)))
    return out if gone_column else out.drop(name)


def report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """Every document's numbers of lines, which of them go, and a digest of what stays."""
    plain = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long")
    done = dedup(plain.withColumn("n_lines", n_lines), "doc_id", "text", "gone", **options)
    gone = F.coalesce("gone", F.expr("cast(array() as array<int>)"))
    return done.select(
        "doc_id",
        "n_lines",
        F.size(gone).cast("long").alias("n_removed_lines"),
        F.array_join(gone.cast("array<string>"), ",").alias("removed_lines"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
