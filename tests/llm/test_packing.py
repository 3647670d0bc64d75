import random

import pytest

from recordflow.llm import packing
from text_cases import messy_rows, prose


def plain(pieces, capacity):
    """Best fit by looking at every bin."""
    bins, placed = [], []
    for size, source, cluster in pieces:
        fitting = [
            (left, k)
            for k, (left, sources, clusters) in enumerate(bins)
            if left >= size and (source < 0 or source not in sources) and (cluster < 0 or cluster not in clusters)
        ]
        if fitting:
            _, k = min(fitting)
        else:
            k = len(bins)
            bins.append((capacity, set(), set()))
        left, sources, clusters = bins[k]
        bins[k] = (left - size, sources | {source}, clusters | {cluster})
        placed.append(k)
    return placed


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_agrees_with_plain_search(seed):
    rng = random.Random(seed)
    pieces = [(rng.randint(0, 100), rng.choice([-1, 0, 0, 0, 1, 2, 3]), rng.choice([-1, -1, 0, 1])) for _ in range(300)]
    assert packing.best_fit(pieces, 100) == plain(pieces, 100)


@pytest.mark.parametrize("shard_rows", [4_096, 3])
def test_pack_places_every_word_once(messy, shard_rows):
    got = packing.pack(messy, capacity=100, shard_rows=shard_rows).collect()
    sizes = {}
    for r in messy_rows():
        n = len((r[1] or "").split())
        sizes.setdefault((r[0], n), 0)
        sizes[r[0], n] += 1
    assert sum(r.n_words for r in got) == sum(n * k for (_, n), k in sizes.items())
    assert sum(r.piece == 0 for r in got) == len(messy_rows())
    by_bin = {}
    for r in got:
        by_bin.setdefault(r.bin_id, []).append(r)
        assert r.start == r.piece * 100
    for rows in by_bin.values():
        assert sum(r.n_words for r in rows) <= 100
        sources = [r.source for r in rows if r.source is not None]
        assert len(sources) == len(set(sources))


def test_copies_do_not_share_a_bin(spark):
    text = prose(21, 10)
    docs = spark.createDataFrame([(i, text.upper() if i % 2 else text, f"s{i}") for i in range(20)], "doc_id long, text string, source string")
    got = packing.pack(docs).collect()
    assert len({r.bin_id for r in got}) == 20
    named = packing.pack(docs.selectExpr("*", "cast(null as string) as cluster"), cluster_column="cluster").collect()
    assert len({r.bin_id for r in named}) == 1


def test_empty_table(no_docs):
    assert packing.pack(no_docs).count() == 0
