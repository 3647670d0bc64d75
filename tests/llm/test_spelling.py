import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from recordflow.llm import spelling
from text_cases import messy_rows


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(rows, min_letters, min_count, slips):
    counts = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if slips and h % slips == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_letters and n >= min_count}


def plain(counts):
    form, near = {}, {}
    for w in counts:
        others = [o for o in counts if one_apart(w, o)]
        near[w] = len(others)
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], near[w], counts[form[w]] if form[w] else None))
    return sorted(out)


def vocabulary(seed, n):
    """Words with their edits and permutations, and counts over several powers of five."""
    rng = random.Random(seed)
    letters = "abdeéÀÿz"
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(6, 9))) for _ in range(n)}
    for w in list(words):
        i = rng.randrange(len(w))
        words |= {w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :], "".join(rng.sample(w, len(w)))}
    return {w: 5 ** rng.randint(0, 6) * rng.randint(5, 9) for w in words}


@pytest.mark.parametrize("seed, cell_words, sample", [(1, 8_000, 100_000), (2, 20, 100_000), (3, 20, 5), (4, 15, 0)])
def test_agrees_with_all_pairs(spark, monkeypatch, seed, cell_words, sample):
    monkeypatch.setattr(spelling, "SAMPLED_PER_CELL", 4)
    monkeypatch.setattr(spelling, "SAMPLE_WORDS", sample)
    monkeypatch.setattr(spelling.near_words, "__defaults__", (cell_words, sample))
    counts = vocabulary(seed, 120)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted(tuple(r) for r in spelling.variants(words, cell_words=cell_words).collect())
    assert got == plain(counts)


def test_permutations_of_the_same_letters(spark):
    """No letter count tells these apart: one leaf, dealt over tasks."""
    rng = random.Random(5)
    counts = {"".join(rng.sample("abcdefgh", 8)): rng.choice([5, 30, 200]) for _ in range(150)}
    counts |= {w[:3] + "x" + w[4:]: 5 for w in list(counts)[:40]}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted(tuple(r) for r in spelling.variants(words, cell_words=20).collect())
    assert got == plain(counts)


@pytest.mark.parametrize("slips", [None, 3])
def test_counts_of_messy_documents(messy, slips):
    got = {r.word: r.n for r in spelling.count_words(messy, min_letters=4, min_count=2, slips=slips).collect()}
    assert got == plain_counts(messy_rows(), 4, 2, slips)


def test_tree_reaches_all_within_range():
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abcdef") for _ in range(7)) for _ in range(400)})
    codes = spelling.letters_of(words)
    alphabet = np.unique(codes)
    tree = spelling.Tree.over(spelling.counted(codes, alphabet), alphabet, 4)
    found = {(int(q), int(m)) for rows, members in spelling.near_pairs(tree, codes, codes, alphabet) for q, m in zip(rows, members)}
    assert found == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_apart(a, b)}
    row, _ = tree.reach(spelling.counted(codes, alphabet), alphabet, 1, 1)
    assert len(row) < len(words) * len(tree.members) / 2


def test_empty_tables(spark, no_docs):
    assert spelling.variants(spelling.count_words(no_docs)).count() == 0
    alone = spark.createDataFrame([("lonely", 7)], "word string, n long")
    assert [tuple(r) for r in spelling.variants(alone).collect()] == [("lonely", None, "lonely", 7, 0, None)]
