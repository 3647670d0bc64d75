import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordflow.llm import mixing
from text_cases import messy_rows, prose


def plain_targets(sizes, most=3):
    """Water filling, one source at a time."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in stopped)
        free = [s for s in order if s not in stopped]
        over = [s for s in free if weight[s] * left / sum(weight[x] for x in free) > most * sizes[s]]
        if not over:
            break
        stopped |= set(over)
    each = left / sum(weight[s] for s in free) if free else 0
    return {s: float(most * sizes[s]) if s in stopped else weight[s] * each for s in order}


@pytest.mark.parametrize("few", [mixing.STRETCH_BLOCKS, 2])
def test_mix_of_messy_documents(messy, monkeypatch, few):
    monkeypatch.setattr(mixing, "STRETCH_BLOCKS", few)
    mixed = mixing.mix(messy, shard_blocks=7)
    got = mixing.report(mixed).collect()
    assert len(got) == len(messy_rows())
    sizes, taken = Counter(), Counter()
    for _, text, _, source, _ in messy_rows():
        sizes[source] += len((text or "").split())
    want = plain_targets(sizes)
    for r in got:
        assert r.taken <= 3 * r.size
    assert sorted({(r.source_size, round(r.target, 6)) for r in got}) == sorted({(sizes[s], round(t, 6)) for s, t in want.items()})
    drawn = mixed.drawn.collect()
    for r in drawn:
        taken[r.source] += r.n_words
        assert 0 < r.n_words <= mixing.BLOCK_WORDS and r.first_word + r.n_words <= r.size
    assert taken == {s: round(t) for s, t in want.items() if round(t)}
    assert sum(r.taken for r in got) == sum(taken.values())
    # Shards of equal size, places without gaps, no block more than three times.
    shards = defaultdict(list)
    for r in drawn:
        shards[r.shard].append(r.place)
    assert sorted(shards) == list(range(math.ceil(len(drawn) / 7)))
    assert all(sorted(p) == list(range(len(p))) for p in shards.values())
    assert all(len(shards[k]) == 7 for k in sorted(shards)[:-1])
    assert max(Counter((r.doc_id, r.source, r.doc_print, r.copy, r.first_word) for r in drawn).values()) <= 3


@pytest.mark.parametrize("words", [429_496_730, 2_147_483_646, 2_147_483_648, 30_000_000_000])
def test_targets_of_many_words(spark, words):
    """A total that fits an integer, times a weight, need not."""
    sizes = {"a": words // 2, "b": words // 3, "c": words // 100}
    sizes["d"] = words - sum(sizes.values())
    units = spark.createDataFrame([(s, n // 1000, 1000) for s, n in sizes.items()] + [(s, n % 1000, 1) for s, n in sizes.items()], "_source string, _size long, _copies long")
    got = {r["_source"]: (r.source_size, r.target) for r in mixing.targets(units).collect()}
    assert got == {s: (sizes[s], pytest.approx(t)) for s, t in plain_targets(sizes).items()}


def test_reruns_agree(make_docs):
    docs = make_docs(*[prose(i, 30 + i) for i in range(60)])
    first, second = (mixing.mix(docs.repartition(n), shard_blocks=5).drawn.collect() for n in (1, 7))
    assert sorted(map(tuple, first)) == sorted(map(tuple, second))
    by_source = Counter((r.shard, r.source) for r in first)
    assert len(by_source) > len({r.shard for r in first})


def test_quotas_are_dealt_exactly(spark):
    want = {0: 1_000_003, 1: 17, 2: 1, 3: 50_000, 4: 0}
    total = sum(want.values())
    size = -(-total // 21)
    quotas = spark.createDataFrame(list(want.items()), "_s long, q long")
    shards = mixing.split_quotas(quotas, 21, size).collect()
    got = Counter()
    for r in shards:
        assert sum(x.q for x in r.quotas) == (size if r.shard < 20 else total - 20 * size)
        for x in r.quotas:
            got[x.s] += x.q
    assert got == {s: q for s, q in want.items() if q}
    again = mixing.split_quotas(quotas.repartition(3), 21, size).collect()
    assert sorted(map(str, shards)) == sorted(map(str, again))


def log_choose(n, k):
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


@pytest.mark.parametrize("good, bad, drawn", [(10, 20, 7), (20, 10, 25), (3, 500, 100), (40, 40, 40), (1, 1, 1), (5_000, 9_000, 700)])
def test_draws_follow_the_distribution(spark, good, bad, drawn):
    n = 20_000
    columns = [F.lit(x).cast("long") for x in (good, bad, drawn)]
    got = Counter(r.x for r in spark.range(n).select(mixing.hypergeometric(*columns, F.lit(5), F.col("id")).alias("x")).collect())
    low, high = max(0, drawn - bad), min(good, drawn)
    assert min(got) >= low and max(got) <= high
    odd = cells = 0.0
    for k in range(low, high + 1):
        expected = n * math.exp(log_choose(good, k) + log_choose(bad, drawn - k) - log_choose(good + bad, drawn))
        if expected >= 8:
            odd += (got[k] - expected) ** 2 / expected
            cells += 1
    assert odd < cells + 5 * math.sqrt(2 * cells) + 5


def test_draws_at_the_ends_and_of_huge_sets(spark):
    cases = [(0, 5, 3, 0, 0), (5, 0, 3, 3, 3), (5, 5, 0, 0, 0), (5, 5, 10, 5, 5), (10**11, 10**11, 10**11, 5 * 10**10 - 10**7, 5 * 10**10 + 10**7)]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i long, good long, bad long, drawn long, low long, high long")
    for r in rows.withColumn("x", mixing.hypergeometric(F.col("good"), F.col("bad"), F.col("drawn"), F.col("i"))).collect():
        assert r.low <= r.x <= r.high


def test_log_factorial(spark):
    for r in spark.createDataFrame([(float(x),) for x in (0, 1, 2, 7, 30, 1000, 10**9)], "n double").withColumn("l", mixing.log_factorial(F.col("n"))).collect():
        assert np.isclose(r.l, math.lgamma(r.n + 1), rtol=1e-12, atol=1e-9)


def test_empty_and_wordless_tables(no_docs, make_docs):
    assert mixing.report(mixing.mix(no_docs)).count() == 0
    got = mixing.report(mixing.mix(make_docs(None, "", " \n"))).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 3


def test_no_python_on_the_main_path(messy):
    plan = mixing.report(mixing.mix(messy))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
