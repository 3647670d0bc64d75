"""Spelling variants: words one edit apart, found with k-d trees over their letter counts.

One inserted or deleted letter changes a word's vector of letter counts by one, a replaced letter
adds one and takes one away: an L1 distance of at most two. Words of each length form a k-d tree
over these vectors; a range search per pair of lengths (equal, and one more) goes down only into
boxes that so few added and removed letters reach, and the order of the letters is then compared.

The upper part of the trees, built from a sample of the vocabulary, deals words to cells; a word
is looked up in every cell whose box its range meets, and each cell is a tree of its own in one
task. The sample (``SAMPLE_WORDS``) only balances the cells. A cell with more words than meant, by
a poor sample or because many words are permutations of the same letters, is dealt over several
tasks, each of which sees all that look there. Pairs stay in their tasks: a task returns a number
of near words and the best of them for every word.

Null and empty texts have no words; repeated rows count as often as they stand there; a null ID
reads as an empty one; ties go to the smallest word in code-point order; an empty table gives an
empty result. Only the named columns are read, so others can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from recordflow.llm.common import lower_ascii, written
from recordflow.operators.joins import same_key

LETTER = "A-Za-zÀ-ÿ"
MIN_LETTERS, MIN_COUNT, RATIO = 6, 5, 5
CELL_WORDS = 8_000
SAMPLE_WORDS = 100_000
SAMPLED_PER_CELL = 64
LEAF_WORDS = 12
QUERIES_AT_ONCE = 2_048
# A cut is sought among this many vectors of a box.
CUT_ROWS = 2_000


def count_words(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    slips: int | None = None,
) -> DataFrame:
    """``word, n``: runs of letters, A-Z lower-cased, of that many letters and occurrences at least.

    `slips`: in one of so many pairs of document and word, by a checksum, one letter is left out
    of the word, as a typist would. Counting is an aggregate with a map-side part, so a frequent
    word is one row a task.
    """
    found = F.regexp_extract_all(F.coalesce(F.col(text_column), F.lit("")), F.lit(f"[{LETTER}]{{{min_letters},}}"), F.lit(0))
    words = docs.select(F.col(id_column).cast("string").alias("_id"), F.explode(found).alias("_run"))
    words = words.select("_id", lower_ascii(F.col("_run")).alias("word"))
    if slips:
        words = words.withColumn("_sum", F.crc32(F.concat(F.coalesce("_id", F.lit("")), F.lit(":"), "word").cast("binary")))
        gone = (F.col("_sum") % F.length("word")).cast("int")
        short = F.concat(F.substr("word", F.lit(1), gone), F.substr("word", gone + 2))
        words = words.withColumn("word", F.when(F.col("_sum") % slips == 0, short).otherwise(F.col("word")))
        words = words.filter(F.length("word") >= min_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def letters_of(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.array(words, dtype=f"<U{len(words[0])}").view(np.uint32).reshape(len(words), -1)


def counted(codes: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """Letter counts; a last column of zeros stands for all letters outside of the alphabet."""
    wide = len(alphabet) + 1
    at = np.searchsorted(alphabet, codes)
    known = alphabet[np.minimum(at, len(alphabet) - 1)] == codes
    flat = (np.arange(len(codes))[:, None] * wide + at)[known]
    return np.bincount(flat, minlength=len(codes) * wide).reshape(len(codes), wide).astype(np.int16)


@dataclass
class Tree:
    """A k-d tree over letter counts: nodes with a letter and a cut, leaves with members."""

    letter: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)  # of a leaf: its number
    right: list[int] = field(default_factory=list)  # of a leaf: -1
    members: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def over(cls, counts: np.ndarray, alphabet: np.ndarray, leaf_size: int) -> Tree:
        tree = cls()
        todo = [(np.arange(len(counts)), -1, False)]
        while todo:
            rows, parent, on_right = todo.pop()
            here = len(tree.letter)
            if parent >= 0:
                (tree.right if on_right else tree.left)[parent] = here
            split = cls._split(counts, rows) if len(rows) > leaf_size else None
            if split is None:
                for part, value in ((tree.letter, 0), (tree.cut, 0), (tree.left, len(tree.members)), (tree.right, -1)):
                    part.append(value)
                tree.members.append(rows)
                continue
            column, cut = split
            for part, value in ((tree.letter, int(alphabet[column])), (tree.cut, cut), (tree.left, 0), (tree.right, 0)):
                part.append(value)
            low = counts[rows, column] <= cut
            todo += [(rows[~low], here, True), (rows[low], here, False)]
        return tree

    @staticmethod
    def _split(counts: np.ndarray, rows: np.ndarray) -> tuple[int, int] | None:
        """The letter and number that halve the rows best; None if all are alike."""
        seen = counts[rows[:: max(1, len(rows) // CUT_ROWS)], :-1]
        best, found = 0, None
        for cut in range(int(seen.max(initial=0))):
            low = (seen <= cut).sum(0)
            even = np.minimum(low, len(seen) - low)
            at = int(even.argmax())
            if even[at] > best:
                best, found = even[at], (at, cut)
        if found is None and len(seen) < len(rows):
            varied = np.flatnonzero(counts[rows, :-1].min(0) < counts[rows, :-1].max(0))
            found = (int(varied[0]), int(counts[rows, varied[0]].min())) if len(varied) else None
        return found

    def reach(self, counts: np.ndarray, alphabet: np.ndarray, added: int, removed: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of row and leaf: boxes within reach of so many added and removed letters."""
        letter, cut, left, right = (np.array(x) for x in (self.letter, self.cut, self.left, self.right))
        at = np.searchsorted(alphabet, letter)
        column = np.where(alphabet[np.minimum(at, len(alphabet) - 1)] == letter, at, len(alphabet))
        row, node = np.arange(len(counts)), np.zeros(len(counts), np.int64)
        up, down = np.full(len(counts), added), np.full(len(counts), removed)
        rows, leaves = [], []
        while len(row):
            leaf = right[node] < 0
            rows.append(row[leaf])
            leaves.append(left[node[leaf]])
            row, node, up, down = row[~leaf], node[~leaf], up[~leaf], down[~leaf]
            over = counts[row, column[node]] - cut[node]
            fewer, more = np.maximum(over, 0), np.maximum(1 - over, 0)
            low, high = fewer <= down, more <= up
            row, node, up, down = (
                np.concatenate([row[low], row[high]]),
                np.concatenate([left[node[low]], right[node[high]]]),
                np.concatenate([up[low], (up - more)[high]]),
                np.concatenate([(down - fewer)[low], down[high]]),
            )
        return np.concatenate(rows), np.concatenate(leaves)


def one_apart(some: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether words, row by row, differ by one replaced or (`others` longer) inserted letter."""
    if some.shape[1] == others.shape[1]:
        return (some != others).sum(1) == 1
    head = np.logical_and.accumulate(some == others[:, :-1], 1).sum(1)
    tail = np.logical_and.accumulate((some == others[:, 1:])[:, ::-1], 1).sum(1)
    return head + tail >= some.shape[1]


def near_pairs(tree: Tree, members: np.ndarray, queries: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of `queries` and `members` that are one edit apart."""
    removed = int(queries.shape[1] == members.shape[1])
    order = np.concatenate(tree.members)
    sizes = np.array([len(m) for m in tree.members])
    starts = np.cumsum(sizes) - sizes
    for low in range(0, len(queries), QUERIES_AT_ONCE):
        part = queries[low : low + QUERIES_AT_ONCE]
        row, leaf = tree.reach(counted(part, alphabet), alphabet, 1, removed)
        n = sizes[leaf]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        member, row = order[np.repeat(starts[leaf], n) + inside], np.repeat(row, n)
        near = one_apart(part[row], members[member])
        yield row[near] + low, member[near]


def _by_length(words: pd.Series) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of the words of each length."""
    lengths = words.str.len().to_numpy()
    for length in np.unique(lengths):
        yield int(length), np.flatnonzero(lengths == length)


@dataclass(frozen=True)
class Cells:
    """The upper trees, one per length; a cell is a leaf of one."""

    trees: dict[int, Tree]
    first: dict[int, int]

    @classmethod
    def of(cls, sample: list[str], leaf_size: int) -> Cells:
        trees, first, n = {}, {}, 0
        for length, at in _by_length(pd.Series(sample, dtype=object)):
            codes = letters_of([sample[i] for i in at])
            alphabet = np.unique(codes)
            trees[length] = Tree.over(counted(codes, alphabet), alphabet, leaf_size)
            trees[length].members, first[length], n = [], n, n + len(trees[length].members)
        return cls(trees, first)

    def reached(self, words: list[str], length: int, added: int, removed: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of `words` and the cells of words of `length` in their range."""
        if length not in self.trees:
            return np.arange(len(words)), np.full(len(words), -length)
        codes = letters_of(words)
        alphabet = np.unique(codes)
        row, leaf = self.trees[length].reach(counted(codes, alphabet), alphabet, added, removed)
        return row, leaf + self.first[length]


def _looked_up(found: pd.DataFrame) -> pd.DataFrame:
    """One task of a cell: for each word, how many words it is near to here, and the best of them."""
    home = found["role"].to_numpy() == 0
    words, n = found["word"].to_numpy(), found["n"].to_numpy()
    order = np.lexsort((np.argsort(np.argsort(words)), -n))
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    near, best = np.zeros(len(words), np.int64), np.full(len(words), len(words))
    tree_rows = np.flatnonzero(home)
    if len(tree_rows):
        members = letters_of(list(words[tree_rows]))
        asked = [np.flatnonzero(found["role"].to_numpy() == role) for role in (1, 2)]
        queries = [letters_of(list(words[rows])) if len(rows) else None for rows in asked]
        alphabet = np.unique(np.concatenate([np.unique(q) for q in (members, *queries) if q is not None]))
        tree = Tree.over(counted(members, alphabet), alphabet, LEAF_WORDS)
        for rows, codes in zip(asked, queries):
            if codes is None:
                continue
            for row, member in near_pairs(tree, members, codes, alphabet):
                me, other = rows[row], tree_rows[member]
                # Words of one length ask for each other; of two lengths only the shorter asks.
                both = [(me, other)] if codes.shape == members.shape or codes.shape[1] == members.shape[1] else [(me, other), (other, me)]
                for a, b in both:
                    np.add.at(near, a, 1)
                    np.minimum.at(best, a, place[b])
    some = np.flatnonzero(near)
    top = order[best[some]]
    return pd.DataFrame({"word": words[some], "n_near": near[some], "best_n": n[top], "best": words[top]})


def near_words(words: DataFrame, cell_words: int = CELL_WORDS, sample_words: int = SAMPLE_WORDS) -> DataFrame:
    """``word, n_near, best, best_n`` of every word of `words` (``word, n``) that has a near word."""
    there = words.count()
    wanted = min(sample_words, max(1, SAMPLED_PER_CELL * there // cell_words))
    part = F.pmod(F.xxhash64("word", F.lit("sample")), F.lit(1 << 30))
    sample = [r.word for r in words.filter(part < int((1 << 30) * wanted / max(1, there))).select("word").collect()]
    cells = words.sparkSession.sparkContext.broadcast(Cells.of(sorted(sample), SAMPLED_PER_CELL))

    def homes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell = np.zeros(len(batch), np.int64)
            for length, at in _by_length(batch["word"]):
                row, found = cells.value.reached(list(batch["word"].iloc[at]), length, 0, 0)
                cell[at[row]] = found
            yield pd.DataFrame({"cell": cell, "words": 1}).groupby("cell", as_index=False).sum()

    sizes = words.mapInPandas(homes, "cell long, words long").groupBy("cell").agg(F.sum("words").alias("words"))
    # One row per cell, and cells are at most the sample's leaves and one per length.
    full = sizes.filter(F.col("words") > 2 * cell_words).collect()
    chunks = words.sparkSession.sparkContext.broadcast({r.cell: -(-r.words // cell_words) for r in full})

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, at in _by_length(batch["word"]):
                some = batch.iloc[at].reset_index(drop=True)
                texts = list(some["word"])
                for role, wanted, added, removed in ((0, length, 0, 0), (1, length, 1, 1), (2, length + 1, 1, 0)):
                    row, cell = cells.value.reached(texts, wanted, added, removed)
                    n = np.array([chunks.value.get(c, 1) for c in cell.tolist()], np.int64)
                    if role == 0:
                        chunk = some["part"].to_numpy()[row] % n
                    else:
                        chunk = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                        row, cell = np.repeat(row, n), np.repeat(cell, n)
                    yield pd.DataFrame({"cell": cell, "chunk": chunk, "role": role, "word": some["word"].to_numpy()[row], "n": some["n"].to_numpy()[row]})

    spread = words.select("word", "n", F.pmod(F.xxhash64("word"), F.lit(1 << 30)).alias("part"))
    asked = spread.mapInPandas(dealt, "cell long, chunk long, role int, word string, n long")
    found = asked.groupBy("cell", "chunk").applyInPandas(_looked_up, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best")).select(
        "word", "n_near", F.col("_best.word").alias("best"), (-F.col("_best.n")).alias("best_n")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: each round doubles how far every word has followed its forms.

    A form occurs `RATIO` times as often as its word, so chains are short and have no rings.
    """
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = roots.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        moved = roots.join(ahead, same_key(roots["root"], F.col("_at")), "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")
        )
        moved = written(moved, "roots")
        roots = moved.drop("_moved")
        if moved.filter("_moved").isEmpty():
            return roots


def variants(words: DataFrame, ratio: int = RATIO, cell_words: int = CELL_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of `words` (``word, n``, words distinct).

    A word's form is its near word of largest count if that is `ratio` times the word's own at
    least; its root is the end of the chain of forms.
    """
    words = written(words.select("word", "n"), "words")
    near = near_words(words, cell_words)
    near = near.withColumnRenamed("word", "_near_word")
    is_form: Column = F.col("best_n") >= ratio * F.col("n")
    known = words.join(near, same_key(words["word"], near["_near_word"]), "left").select(
        "word",
        F.when(is_form, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    known = written(known, "forms")
    roots = _roots(known.filter(F.col("form").isNotNull())).withColumnRenamed("word", "_root_word")
    return known.join(roots, same_key(known["word"], roots["_root_word"]), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
