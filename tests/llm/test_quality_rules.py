import random
import re

from recordflow.llm import quality_rules as rules

from text_cases import messy_rows, prose


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    inside = {k for starts in windows.values() if len(starts) > 1 for i in starts for k in range(i, i + 8)}
    seen, repeats = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeats, len(inside)


def test_counts_agree_with_plain_search(messy):
    texts = [r[1] for r in messy_rows()] + ["a b c d e f g h " * 5, "a b c d e f g h", "a b " * 9, "x\nx\n \nx\r\nx\r"]
    for text in texts:
        assert rules.counts(text)[:5] == plain(text)
    judged = rules.judge(messy, [])
    assert "counts" not in judged.columns and judged.count() == len(messy_rows())
    for r in judged.collect():
        n, repeats = r.n_words, r.n_repeat_words
        assert r.base_failed == (n < 20 or 100 * repeats > 30 * n) and r.kept == (not r.base_failed)


def test_learns_an_ordered_list(spark, make_docs):
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(400):
        text = prose(100 + i, rng.randint(30, 90))
        if i % 4 == 0:
            text = text.replace(" ", "### ")
        elif i % 4 == 1 and i % 8 == 1:
            text = text.upper()
        texts.append(text)
        labels.append((i, 0 if i % 4 == 0 or i % 8 == 1 else 1))
    docs = make_docs(*texts)
    found = rules.fit(docs, spark.createDataFrame([*labels, (None, 0), (5, None)], "doc_id long, quality int"))
    assert len(found) >= 2 and all(1 <= len(r) <= 4 for r in found)
    kept = {r.doc_id: r.kept for r in rules.judge(docs, found).collect()}
    assert sum(kept[i] == bool(y) for i, y in labels) >= 0.97 * len(labels)
    assert found == rules.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))


def test_empty_tables(spark, messy, no_docs):
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    assert rules.fit(messy, nothing) == [] and rules.fit(no_docs, nothing) == []
    assert rules.judge(no_docs, []).count() == 0
