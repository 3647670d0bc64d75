import hashlib
import re

from recordflow.llm import decontaminate
from recordflow.llm.common import LOWER, UPPER, WORD

from text_cases import messy_rows, prose


def plain_words(text):
    return re.findall(WORD, (text or "").translate(str.maketrans(UPPER, LOWER)))


def plain(text, items):
    words, hit, found = plain_words(text), set(), set()
    for item, item_text in items:
        ws = plain_words(item_text)
        n = min(10, len(ws))
        for window in {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if ws else ():
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) == window:
                    hit.update(range(i, i + n))
                    if item is not None:
                        found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), digest, bool(hit)


def items_of():
    base = prose(1, 120)
    return [(1, " ".join(base.split()[5:30])), (2, base.upper()), (10, "one"), (11, None), (12, ""), (None, " ".join(base.split()[40:60])), (1, prose(3, 15))]


def test_report_agrees_with_plain_search(spark, messy):
    items = items_of()
    benchmark = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, n_words int")
    got = sorted((tuple(r) for r in decontaminate.report(messy, benchmark).collect()), key=repr)
    want = sorted(((r[0], *plain(r[1], items)) for r in messy_rows()), key=repr)
    assert got == want


def test_beyond_the_broadcast_bound(spark, messy, monkeypatch):
    benchmark = spark.createDataFrame(items_of(), "item_id long, text string")
    want = sorted((tuple(r) for r in decontaminate.report(messy, benchmark).collect()), key=repr)
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_WINDOWS", 0)
    assert sorted((tuple(r) for r in decontaminate.report(messy, benchmark).collect()), key=repr) == want


def test_removes_documents_or_spans(spark, make_docs):
    leak = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    docs = make_docs(f"Before it, {leak}! After it.", "Nothing, here.", None, f"{leak} {leak}")
    benchmark = spark.createDataFrame([(1, leak.lower())], "item_id long, text string")
    whole = decontaminate.decontaminate(docs, benchmark)
    assert whole.columns == docs.columns
    assert sorted(r.doc_id for r in whole.collect()) == [1, 2]
    spans = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, benchmark, "spans").collect()}
    assert spans == {0: "Before it, After it.", 1: "Nothing, here.", 2: None, 3: ""}


def test_empty_tables(spark, messy, no_docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.report(messy, nothing).collect())
    assert decontaminate.report(no_docs, nothing).count() == 0
    assert decontaminate.decontaminate(messy, nothing).count() == messy.count()


def test_only_native_operators(spark, messy):
    benchmark = spark.createDataFrame(items_of(), "item_id long, text string")
    plan = decontaminate.report(messy.select("doc_id", "text"), benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
