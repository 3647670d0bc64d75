"""Token counts of whole texts, equal to the tokenizer library's, by a lookup in two tiers.

A byte-level BPE encodes every pre-token on its own, so a text's count is the sum of its
pre-tokens' lengths. The first tier is a broadcast table of the pre-tokens that are frequent in
the corpus; misses go to the library once per worker and are kept in a bounded cache. Texts never
leave their tasks, and pre-tokens only as each task's frequent ones.

The table can't grow with the corpus: a pre-token is frequent if it makes up at least one in
``FREQUENT_SHARE`` of all pre-tokens, so at most that many are. It changes speed, never counts.

Nulls and empty texts have no bytes and no tokens; repeated rows and null IDs are counted like
any other; an empty table gives an empty result. Columns of the same name are replaced.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from recordflow.llm.common import written

FREQUENT_SHARE = 200_000
CACHE_ENTRIES = 200_000
# A task reports its commonest pre-tokens; the rest can't be frequent in many tasks.
REPORTED_PER_TASK = 4_096
COUNTED_AT_ONCE = 300_000


class Lengths(dict):
    """Number of tokens of each pre-token: frequent ones from the start, others as they come."""

    def __init__(self, frequent: dict[str, int], encode: Callable[[str], int], limit: int = CACHE_ENTRIES):
        super().__init__(frequent)
        self.frequent, self.encode, self.limit = frequent, encode, len(frequent) + limit

    def __missing__(self, token: str) -> int:
        n = self.encode(token)
        if len(self) >= self.limit:
            self.clear()
            self.update(self.frequent)
        self[token] = n
        return n


def settled_characters() -> str:
    """A pattern class of the characters that Unicode 3.2 knows: no library classes them otherwise."""
    known = unicodedata.ucd_3_2_0
    codes = [c for c in range(0x110000) if known.category(chr(c)) not in ("Cn", "Cs", "Co")]
    starts = [c for c, before in zip(codes, [-2, *codes]) if c != before + 1]
    stops = [c for c, after in zip(codes, [*codes[1:], -2]) if c != after - 1]
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in zip(starts, stops))


class Splitter:
    """Cuts texts into pre-tokens as the tokenizer file does; counts special strings apart.

    Two libraries may know different versions of Unicode. A text with a character younger than
    version 3.2 is therefore not cut here: the tokenizer encodes it whole.
    """

    def __init__(self, path: str, pattern: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.find = regex.compile(pattern).findall
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.unsettled = regex.compile(f"[^{settled_characters()}]").search
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens, and the number of special strings between them."""
        if self.special is None or not self.special.search(text):
            return self.find(text), 0
        parts = self.special.split(text)
        return [token for part in parts for token in self.find(part)], len(parts) - 1

    def length(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def whole(self, text: str) -> bool:
        """Whether the text is to be encoded whole."""
        return not text.isascii() and self.unsettled(text) is not None


_SPLITTERS: dict[tuple[str, str], Splitter] = {}


def splitter(path: str, pattern: str) -> Splitter:
    """One tokenizer per worker."""
    if (path, pattern) not in _SPLITTERS:
        _SPLITTERS[path, pattern] = Splitter(path, pattern)
    return _SPLITTERS[path, pattern]


def frequent_pretokens(docs: DataFrame, path: str, pattern: str, text_column: str = "text", share: int = FREQUENT_SHARE) -> DataFrame:
    """``token, n``: the pre-tokens that make up at least one in `share` of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, counts, total = splitter(path, pattern), Counter(), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text and not cutter.whole(text):
                    found = cutter.pieces(text)[0]
                    counts.update(found)
                    total += len(found)
            if len(counts) > COUNTED_AT_ONCE:
                counts = Counter(dict(counts.most_common(COUNTED_AT_ONCE // 4)))
        top = counts.most_common(REPORTED_PER_TASK)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None] + [t for t, _ in top], pa.string()), pa.array([total] + [n for _, n in top], pa.int64())],
            ["token", "n"],
        )

    # Read twice, and at most the rows that tasks report: written, or all texts would be split twice.
    counted = written(docs.select(text_column).mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n")), "pretokens")
    total = counted.filter(F.col("token").isNull()).select(F.col("n").alias("total"))
    return counted.filter(F.col("token").isNotNull()).join(F.broadcast(total), F.col("n") * share >= F.col("total")).select("token", "n")


def frequent_lengths(docs: DataFrame, path: str, pattern: str, text_column: str = "text", share: int = FREQUENT_SHARE) -> dict[str, int]:
    """The first tier: at most `share` pre-tokens with their numbers of tokens."""
    length = splitter(path, pattern).length
    return {r.token: length(r.token) for r in frequent_pretokens(docs, path, pattern, text_column, share).toLocalIterator()}


def count_tokens(
    docs: DataFrame,
    path: str,
    pattern: str,
    text_column: str = "text",
    count_column: str = "n_tokens",
    share: int = FREQUENT_SHARE,
    cache_entries: int = CACHE_ENTRIES,
) -> DataFrame:
    """`docs` with the number of tokens of every text.

    `path` is a tokenizer file with byte-level pre-tokenization by `pattern`.
    """
    spark: SparkSession = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent_lengths(docs, path, pattern, text_column, share))

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cut = splitter(path, pattern)
        length = Lengths(table.value, cut.length, cache_entries).__getitem__
        for texts in batches:
            out = []
            for text in texts:
                if text and cut.whole(text):
                    out.append(cut.length(text))
                    continue
                pieces, special = cut.pieces(text) if text else ((), 0)
                out.append(sum(map(length, pieces)) + special)
            yield pd.Series(out, dtype="int64")

    return docs.withColumn(count_column, tokens(F.col(text_column)))
