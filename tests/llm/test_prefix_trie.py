import random
import zlib
from collections import defaultdict
from hashlib import md5, sha256

import pytest

from recordflow.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string, conv int, k1 string, place double"


def plain(rows):
    """The trie by dictionaries."""
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c, ts in own.items():
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(base, [])[:h] + ts[h:])
    members, end = defaultdict(list), defaultdict(list)
    for c, ts in built.items():
        end[ts].append(c)
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []

    def below(node):
        saved = (len(members[node]) - 1) * len((node[-1][1]).split()) if node else 0
        leaves = 0 if children[node] else 1
        for child in list(children[node]):
            s, n = below(child)
            saved, leaves = saved + s, leaves + n
        ids = ",".join(map(str, sorted(end[node])))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), parent, len(members[node]), len(children[node]), leaves, saved, sha256(ids.encode()).hexdigest()))
        return saved, leaves

    if built:
        below(())
    return sorted(out, key=repr)


def made(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-45, 130), 90) + [rng.randrange(10**12) for _ in range(5)]:
        for turn in range(rng.choice([0, 1, 1, 2, 3, 4, 5, 9])):
            rows.append((c, rng.choice([turn, turn, turn, 0, None]), rng.choice(["user", "assistant", None, ""]), rng.choice(["a b", "a  b c", "", None, "é 東"])))
    rows += rng.sample(rows, 10) + [(None, 1, "user", "lost"), (None, None, None, None)]
    return [(*r, 1, "x", 2.0) for r in rows]


@pytest.mark.parametrize("seed, block, ends", [(1, 1_024, 4_096), (2, 2, 4_096), (3, 3, 7)])
def test_agrees_with_dictionaries(spark, monkeypatch, seed, block, ends):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "ENDS_AT_ONCE", ends)
    rows = made(seed)
    got = sorted((tuple(r) for r in prefix_trie.trie(spark.createDataFrame(rows, TURNS)).collect()), key=repr)
    assert got == plain(rows)


def test_long_conversation_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    rows = [(1, t, "user", f"turn {t}") for t in range(300)] + [(20 * c, t, "user", f"w {t}") for c in range(400) for t in range(2)]
    rows = [(*r, 1, "x", 2.0) for r in rows]
    got = sorted((tuple(r) for r in prefix_trie.trie(spark.createDataFrame(rows, TURNS)).collect()), key=repr)
    assert got == plain(rows)


def test_empty_table(spark):
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "user", "x", 1, "x", 2.0)], TURNS)).count() == 0
