import hashlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordflow.llm import suffix_dedup as dedup

from text_cases import DOCS, messy_rows, prose


def plain(rows):
    first = {}
    order = lambda r: dedup.LAST if r[0] is None else r[0]
    for r in rows:
        data = (r[1] or "").encode()
        for p in range(len(data) - 49):
            key = data[p : p + 50]
            first[key] = min(first.get(key, order(r)), order(r))
    out = []
    for r in rows:
        data = (r[1] or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 49):
            if first[data[p : p + 50]] < order(r):
                gone[p : p + 50] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((r[0], len(data), int(gone.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_agrees_with_plain_search(messy):
    rows = [r for r in messy_rows() if len(r[1] or "") < 100_000]
    some = messy.filter("length(coalesce(text, '')) < 100000")
    assert sorted((tuple(r) for r in dedup.report(some).collect()), key=repr) == plain(rows)


@pytest.mark.parametrize("pack_bytes", [600, 1 << 20])
def test_repetitive_texts_over_many_packs(spark, monkeypatch, pack_bytes):
    monkeypatch.setattr(dedup, "PACK_BYTES", pack_bytes)
    rng = random.Random(5)
    shared = [prose(50 + k, 14, 99)[: rng.randint(48, 80)] for k in range(4)]
    rows = [(0, "ab" * 80, "", "", 0), (1, "x" + "ab" * 60, "", "", 0), (2, "a" * 49, "", "", 0), (3, "a" * 120, "", "", 0), (4, "ba" * 30 + "a" * 70, "", "", 0)]
    for i in range(5, 60):
        text = "".join(rng.choice([*shared, prose(900 + rng.randrange(12), 9), "abab" * 9]) for _ in range(rng.randint(1, 6)))
        rows.append((rng.choice([i, 70 - i]), text[rng.randint(0, 9) :], "", "", 0))
    found = dedup.report(spark.createDataFrame(rows, DOCS).repartition(5))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(rows)


def test_a_text_longer_than_a_piece():
    data = np.frombuffer((prose(77, 120_000) * 2).encode(), np.uint8)
    assert len(data) > dedup.PIECE
    found = dedup.parse(data, np.array([len(data)]))
    covered = np.zeros(len(data) - 49, int)
    for a, b in zip(found.first, found.last):
        covered[a : b + 1] += 1
    assert (covered == 1).all()


def test_keeps_bytes_and_spans(make_docs):
    base = prose(11, 40, 99)
    got = {r.doc_id: r for r in dedup.dedup(make_docs(base, "start " + base + " end")).collect()}
    assert got[0].kept.decode() == base and got[0].spans == []
    assert [tuple(s) for s in got[1].spans] == [(6, 6 + len(base))] and got[1].kept == b"start  end"


def test_a_bucket_that_many_packs_meet_in():
    """The work of a bucket goes with its phrases, not with its packs times its phrases."""
    rng = np.random.default_rng(3)
    packs, each = 20_000, 20
    key = rng.integers(0, 150_000, (packs, each)).astype(np.uint64) << np.uint64(40)
    doc = rng.integers(0, 1 << 40, (packs, each))
    rows = [
        {"pack": str(i), "keys": k.tobytes(), "groups": bytes(2 * each), "docs": dedup._planes(d)} for i, (k, d) in enumerate(zip(key, doc))
    ]
    began = time.process_time()
    found = {pack: (np.frombuffer(gone, np.uint64), np.frombuffer(asked, np.uint64)) for pack, gone, asked in dedup.met(rows)}
    took = time.process_time() - began
    least, some = {}, {}
    for k, d in zip(key.ravel().tolist(), doc.ravel().tolist()):
        least[k] = min(d, least.get(k, d))
    for k, d in least.items():
        some.setdefault(k >> 48, set()).add(d)
    for i in range(packs):
        gone, asked = found.get(str(i), ([], []))
        pairs = list(zip(key[i].tolist(), doc[i].tolist()))
        assert sorted(gone) == sorted(k for k, d in pairs if least[k] < d)
        assert sorted(asked) == sorted(k for k, d in pairs if least[k] == d and len(some[k >> 48]) > 1)
    assert took < 8


def test_few_rows_pass_between_packs_and_buckets(spark):
    words = F.concat_ws(" ", *[F.sha2(F.concat_ws(":", "id", F.lit(k)), 256) for k in range(160)])
    docs = spark.range(2_000).select(F.col("id").alias("doc_id"), words.alias("text")).coalesce(1)
    table = dedup.written(dedup.packs(docs, "doc_id", "text"), "packs")
    assert table.agg(F.sum("bytes")).first()[0] > 20_000_000
    assert dedup.digests(table, dedup.LEAST_BUCKETS).count() <= 4 * dedup.LEAST_BUCKETS


def test_empty_table(no_docs):
    assert dedup.report(no_docs).count() == 0
