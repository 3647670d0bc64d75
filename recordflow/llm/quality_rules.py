"""Quality rules: counts of every text, and a decision list learned from labelled documents.

Sequential covering grows a conjunction of thresholds on one part of the labelled rows (by
information gain), prunes it on the other, keeps it if it is precise there, takes what it covers
away and goes on. The rules, in order, become one conditional expression.

The list is fitted on a bounded sample (``SAMPLE_ROWS`` labelled rows); the counts and the
verdict cover every text. Null and empty texts have no words, lines or symbols. Repeated rows and
null IDs are judged like others. Without labelled rows of both kinds the list is empty and keeps
everything. Columns of the counts' names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from recordflow.llm.common import bounded_sample

SAMPLE_ROWS = 12_000
REPEAT_WORDS = 8
SPACES = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_bangs", "n_distinct_words", "n_digits",
]


def repeat_words(words: Sequence[bytes], size: int = REPEAT_WORDS) -> int:
    """Words inside windows of `size` words that occur more than once; exact, by doubling ranks."""
    if len(words) <= size:
        return 0
    known: dict[bytes, int] = {}
    rank = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    if len(known) == len(words):
        return 0
    base, width = rank, 1
    while width < size:
        step = min(width, size - width)
        pair = rank[: len(rank) - step] * (int(rank.max()) + 1) + rank[step:]
        distinct, rank = np.unique(pair, return_inverse=True)
        width += step
        if len(distinct) == len(rank):
            return 0
    often = np.bincount(rank)[rank] > 1
    edges = np.zeros(len(base) + 1, np.int64)
    starts = np.flatnonzero(often)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    return int((np.cumsum(edges) > 0).sum())


def counts(text: str | None) -> tuple[int, ...]:
    """The numbers of ``COUNTS`` of one text."""
    text = text or ""
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    upper = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
        upper,
        text.count("!"),
        len(set(words)),
        sum(map(text.count, "0123456789")),
    )


def with_counts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """`docs` with a ``counts`` structure of every text."""
    schema = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"

    @F.pandas_udf(schema)
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([counts(t) for t in texts], columns=COUNTS, dtype="int64")

    return docs.withColumn("counts", measure(F.col(text_column)))


def _per(a: str, b: str) -> Column:
    return F.col(f"counts.{a}") / F.greatest(F.col(f"counts.{b}"), F.lit(1))


def measures() -> dict[str, Column]:
    """What the rules may test, over the ``counts`` structure."""
    return {
        "words": F.col("counts.n_words").cast("double"),
        "chars_per_word": _per("word_chars", "n_words"),
        "symbols_per_word": _per("n_symbols", "n_words"),
        "dup_line_share": _per("n_dup_lines", "n_lines"),
        "repeat_share": _per("n_repeat_words", "n_words"),
        "words_per_line": _per("n_words", "n_lines"),
        "upper_share": _per("n_upper", "word_chars"),
        "bangs_per_word": _per("n_bangs", "n_words"),
        "distinct_share": _per("n_distinct_words", "n_words"),
        "digit_share": _per("n_digits", "word_chars"),
    }


@dataclass(frozen=True)
class Test:
    """``measure >= threshold``, or ``<``."""

    measure: str
    above: bool
    threshold: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        x = table[self.measure]
        return x >= self.threshold if self.above else x < self.threshold

    def column(self, of: dict[str, Column]) -> Column:
        x = of[self.measure]
        return x >= self.threshold if self.above else x < self.threshold


Rule = tuple[Test, ...]


def covered(rule: Rule, table: dict[str, np.ndarray]) -> np.ndarray:
    rows = len(next(iter(table.values())))
    return np.logical_and.reduce([np.ones(rows, bool), *[t.holds(table) for t in rule]])


def _best_test(table: dict[str, np.ndarray], bad: np.ndarray, inside: np.ndarray) -> tuple[float, Test | None]:
    """The test with the largest information gain among the rows inside a rule so far."""
    p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
    before = np.log2(p0 / (p0 + n0))
    best, chosen = 0.0, None
    for name, values in table.items():
        x, y = values[inside], bad[inside]
        cuts = np.unique(np.quantile(x, np.linspace(0.005, 0.995, 100)))
        order = np.argsort(x, kind="stable")
        below = np.searchsorted(x[order], cuts)
        p_below = np.concatenate([[0], np.cumsum(y[order])])[below]
        for above in (True, False):
            p = p0 - p_below if above else p_below
            total = (p0 + n0) - below if above else below
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / np.maximum(total, 1)) - before), 0.0)
            k = int(np.argmax(gain))
            if gain[k] > best + 1e-9:
                best, chosen = float(gain[k]), Test(name, above, float(cuts[k]))
    return best, chosen


def learn(
    table: dict[str, np.ndarray], bad: np.ndarray, fold: np.ndarray, precision: float = 0.8, max_tests: int = 4, max_rules: int = 24
) -> list[Rule]:
    """Rules for bad rows, in the order found. Rows of fold 0 prune, the others grow."""
    left, rules = np.ones(len(bad), bool), []
    while len(rules) < max_rules and (left & bad & (fold != 0)).sum() >= 5:
        grow, prune = left & (fold != 0), left & (fold == 0)
        rule: Rule = ()
        inside = grow.copy()
        while len(rule) < max_tests and (inside & ~bad).any():
            _, test = _best_test(table, bad, inside)
            if test is None:
                break
            rule += (test,)
            inside &= test.holds(table)

        def worth(r: Rule, prune=prune) -> float:
            on = covered(r, table) & prune
            p, n = (on & bad).sum(), (on & ~bad).sum()
            return (p - n) / (p + n) if p + n else -1.0

        prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
        rule = max(prefixes, key=worth, default=())
        on = covered(rule, table) & prune if rule else np.zeros(len(bad), bool)
        if not rule or not on.any() or (on & bad).sum() < precision * on.sum():
            break
        rules.append(rule)
        left &= ~covered(rule, table)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Keep or not, as ordered conditions over the ``counts`` structure."""
    of = measures()
    chain = F
    for rule in rules:
        condition = rule[0].column(of)
        for test in rule[1:]:
            condition &= test.column(of)
        chain = chain.when(condition, False)
    return chain.otherwise(True) if rules else F.lit(True)


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label: str = "quality", rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn a decision list from about `rows` labelled documents; label 0 is bad."""
    known = labels.filter(F.col(label).isNotNull() & F.col(id_column).isNotNull())
    sample = bounded_sample(known.select(F.col(id_column).alias("_id"), F.col(label).alias("_label")), "_id", rows)
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    found = (
        with_counts(texts.join(F.broadcast(sample), "_id"), "_text")
        .select((F.col("_label") == 0).alias("_bad"), F.pmod(F.xxhash64("_id"), F.lit(3)).alias("_fold"), *[c.alias(n) for n, c in measures().items()])
        .orderBy("_bad", "_fold", *measures())
        .toPandas()
    )
    bad = found["_bad"].to_numpy(bool)
    if bad.all() or not bad.any():
        return []
    return learn({m: found[m].to_numpy(float) for m in measures()}, bad, found["_fold"].to_numpy())


def judge(docs: DataFrame, rules: list[Rule], text_column: str = "text") -> DataFrame:
    """`docs` with the first five counts, the fixed verdict ``base_failed`` and ``kept``."""
    measured = with_counts(docs, text_column)
    n_words, repeats = F.col("counts.n_words"), F.col("counts.n_repeat_words")
    failed = (n_words < 20) | (repeats * 100 > n_words * 30)
    return measured.withColumns(
        {c: F.col(f"counts.{c}") for c in COUNTS[:5]} | {"base_failed": failed, "kept": ~failed & verdict(rules)}
    ).drop("counts")
