import random

import corpus_pipeline
import pytest
from recordflow.llm import toxicity
from test_decontaminate import plain as plain_leak
from test_jaccard_join import near_copies, plain as plain_groups
from test_line_dedup import plain as plain_lines
from test_toxicity import corpus
from text_cases import DOCS, prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with toxic texts, shared blocks, near copies and leaks among clean texts."""
    path = str(tmp_path_factory.mktemp("tables"))
    texts, toxic = corpus(240, 8)
    leak = "The quick red fox jumps over nine lazy dogs while it rains in the north"
    block = "\n".join(f"shared line {i} that stands word for word in both" for i in range(4))
    copies = near_copies(6, 90, edits=1)
    more = [f"{prose(700, 50)}\n{block}", f"{prose(701, 50)}\n{block}", *copies, f"{prose(702, 30)} {leak} {prose(703, 30)}", None, "", prose(704, 5_000)]
    rows = [(i, t, "en", f"s{i % 2}" if i % 7 else None, len(t or "")) for i, t in enumerate([*texts, *more])]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, leak), (2, prose(800, 20))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(i, 1, int(t)) for i, t in enumerate(toxic)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows, {240, 241, 248} | set(range(242, 248)), leak


def test_every_stage_agrees_with_plain_python(spark, folder):
    path, rows, _, leak = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{path}/labels.parquet"))
    left = [r for r in rows if model.score(r[1]) < 0.5]
    gone = plain_lines(left)
    cut = []
    for r in left:
        lost = gone[r[0], r[1] or ""]
        text = r[1] if not lost else "\n".join(line for n, line in enumerate(r[1].split("\n")) if n not in lost)
        if not lost or text.strip():
            cut.append((r[0], text, *r[2:]))
    first = {r[0] for r in plain_groups(cut) if r[0] == r[1]}
    one = [r for r in cut if r[0] in first]
    clean = [r for r in one if not plain_leak(r[1], [(1, leak), (2, prose(800, 20))])[4]]

    found, stages = docs, []
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, found, path)
        stages.append({r.doc_id: r for r in found.collect()})
    for got, want in zip(stages, [left, cut, one, clean]):
        assert {i: r.text for i, r in got.items()} == {r[0]: r[1] for r in want}
    assert set(stages[4]) == {r[0] for r in clean}
    packed = corpus_pipeline.run(spark, path).collect()
    assert sum(r.n_words for r in packed) == sum(len((r[1] or "").split()) for r in clean)


def test_catches_what_is_planted(spark, folder):
    path, rows, planted, _ = folder
    kept = {r.doc_id for r in corpus_pipeline.run(spark, path).collect()}
    toxic = {r[0] for r in rows[:240] if r[0] % 4 == 0}
    assert len(toxic & kept) <= 0.1 * len(toxic)
    assert len(set(range(240)) - toxic - kept) <= 6
    assert 248 not in kept and len(kept & set(range(242, 248))) == 1 and {240, 241, 249, 250, 251} <= kept


def test_order_of_the_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "decontaminate", "packing"]
