import random

import numpy as np
import pytest

from recordflow.llm import jaccard_join as join
from recordflow.llm.components import components
from text_cases import DOCS, messy_rows, prose


def sets_of(text):
    words = join._FIND((text or "").translate(join._LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain(rows, threshold=0.8):
    classes = {}
    for r in rows:
        classes.setdefault(sets_of(r[1]), []).append(r[0])
    smallest = {s: min((i for i in ids if i is not None), default=None) for s, ids in classes.items()}
    found = [s for s in classes if s]
    root, links = {s: s for s in found}, dict.fromkeys(found, 0)

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for i, a in enumerate(found):
        for b in found[:i]:
            shared = len(a & b)
            if shared >= threshold * (len(a) + len(b) - shared):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    groups = {}
    for s in found:
        groups.setdefault(find(s), []).append(smallest[s])
    out = []
    for r in rows:
        s = sets_of(r[1])
        if s:
            group = min((i for i in groups[find(s)] if i is not None), default=None)
            out.append((r[0], group, smallest[s], links[s], len(s)))
        else:
            out.append((r[0], r[0], r[0], 0, 0))
    return sorted(out, key=repr)


def got(docs, **options):
    return sorted((tuple(r)[:5] for r in join.report(docs, **options).collect()), key=repr)


def near_copies(n, seed, words=60, edits=3):
    rng = random.Random(seed)
    base = prose(seed, words).split()
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = rng.choice(["alpha", "beta", "gamma"])
        out.append(" ".join(copy))
    return out


def test_links_agree_with_all_pairs(spark, messy):
    assert got(messy) == plain(messy_rows())
    texts = [t for k in range(6) for t in near_copies(12, 40 + k, edits=k)]
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(texts)]
    assert got(spark.createDataFrame(rows, DOCS)) == plain(rows)


def test_hot_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(join, "BLOCK_MEMBERS", 8)
    rows = [(i, t, "en", "a", 1) for i, t in enumerate([*near_copies(70, 60), *near_copies(1, 61) * 50, *near_copies(9, 62)])]
    assert got(spark.createDataFrame(rows, DOCS)) == plain(rows)


def test_keep_one(spark, messy, make_docs):
    docs = make_docs(*near_copies(5, 70, edits=1), prose(71, 80), None, "")
    assert sorted(r.doc_id for r in join.keep_one(docs).collect()) == [0, 5, 6, 7]
    kept = join.keep_one(messy)
    assert kept.columns == messy.columns
    assert {r.doc_id for r in kept.collect()} >= {1, 3, 4, 5, 6, 8, -5}


def test_banding_meets_its_recall():
    bands, rows = join.banding()
    assert 1 - (1 - 0.8**rows) ** bands >= join.RECALL and bands * rows <= join.MAX_HASHES
    with pytest.raises(ValueError):
        join.banding(0.1, 0.9999, 10)


def test_shared_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, 120)).astype(np.uint64) for _ in range(9)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    shared = join.common(sets)
    assert all(shared[i, j] == want[i][j] for i in range(9) for j in range(9) if i != j)


def test_components(spark):
    rng = random.Random(3)
    edges = [(f"{a:03}", f"{b:03}") for a, b in ((rng.randrange(150), rng.randrange(150)) for _ in range(90))]
    edges += [(f"c{i:03}", f"c{i + 1:03}") for i in range(40)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    want = {n: find(n) for n in list(root)}
    lone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u string, v string")).collect()}
    assert found == {n: r for n, r in want.items() if n not in lone}


def test_empty_table(no_docs):
    assert join.report(no_docs).count() == 0 and join.keep_one(no_docs).count() == 0
