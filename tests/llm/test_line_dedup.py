from itertools import combinations

import pytest

from recordflow.llm import line_dedup as dedup
from text_cases import messy_rows, prose


def plain_patience(values):
    """Length of the longest rising run, by trying all."""
    return max((n for n in range(len(values) + 1) if any(list(c) == sorted(set(c)) for c in combinations(values, n))), default=0)


@pytest.mark.parametrize("values", [[], [1], [3, 1, 2], [5, 4, 3], [1, 9, 2, 8, 3, 7], [2, 2, 3], [4, 1, 5, 2, 6, 3, 7]])
def test_patience_finds_a_longest_run(values):
    chain = dedup.patience(list(range(len(values))), values)
    picked = [values[i] for i in chain]
    assert picked == sorted(set(picked)) and chain == sorted(chain) and len(chain) == plain_patience(values)


def plain(rows, rare_texts=dedup.RARE_TEXTS, min_words=dedup.MIN_WORDS, min_lines=dedup.MIN_LINES):
    """Deleted line numbers by text, from plain dictionaries of whole texts."""
    texts = sorted({(r[0], r[1] or "") for r in rows}, key=lambda k: (k[0] is None, k[0] or 0, dedup_print(k[1])))
    seen = {}
    for place, (_, text) in enumerate(texts):
        for number, line in enumerate(text.split("\n")):
            if line.strip(" "):
                seen.setdefault(line.strip(" "), {}).setdefault(place, []).append(number)
    out = {}
    for place, key in enumerate(texts):
        found = []
        for number, line in enumerate(key[1].split("\n")):
            holders = seen.get(line.strip(" "), {})
            if holders and min(holders) < place:
                hub = min(holders)
                found.append(
                    {"line_no": number, "hub": hub, "hub_line": holders[hub][0], "times": len(holders[hub]), "n_texts": len(holders), "n_words": len(line.split())}
                )
        out[key] = sorted(dedup.blocks(found, rare_texts, min_words, min_lines))
    return out


def dedup_print(text):
    import hashlib

    return hashlib.md5(text.encode()).hexdigest()


def test_deletions_agree_with_plain_search(messy):
    want = plain(messy_rows())
    got = dedup.dedup(messy, gone_column="gone")
    assert set(got.columns) == {*messy.columns, "gone"} and got.count() == len(messy_rows())
    before = sorted(messy_rows(), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    after = sorted(got.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    lost = {(r[0], r[1] or ""): want[r[0], r[1] or ""] for r in before}
    left = {k: "\n".join(line for n, line in enumerate(k[1].split("\n")) if n not in gone) for k, gone in lost.items()}
    assert sorted((r.doc_id, r.text or "") for r in after if r.doc_id is not None) == sorted(
        (r[0], left[r[0], r[1] or ""]) for r in before if r[0] is not None
    )
    assert any(lost.values())


def test_blocks(make_docs):
    base = [f"line number {i} with its own eight words here" for i in range(12)]
    short = ["so it goes", "and on", "the end"]
    docs = make_docs(
        "\n".join(base),
        "\n".join(["something new", *base[3:7], "", *base[7:9], "more that is new"]),
        "\n".join(reversed(base)),
        "\n".join(["unlike all", "so it goes"]),
        "\n".join(["other text", *short]),
        "so it goes",
        "\n".join([base[2], "between them a line that is new", base[5]]),
    )
    gone = {r.doc_id: r.gone for r in dedup.deletions(docs).select("_id", "gone").withColumnRenamed("_id", "doc_id").collect()}
    assert gone[1] == [1, 2, 3, 4, 6, 7]  # the blank line stays and parts two blocks
    assert len(gone[2]) == 1  # only one line of a reversed text is in order
    assert gone[6] == [0, 2]
    assert not {0, 3, 4, 5} & set(gone)


def test_frequent_lines_go_only_with_others(make_docs):
    notice = "this notice of eight words is everywhere here"
    texts = [f"{prose(300 + i, 24)}\n{notice}" for i in range(8)]
    docs = make_docs(*texts, f"{texts[0]}\n{prose(400, 12)}")
    gone = {r._id: r.gone for r in dedup.deletions(docs, rare_texts=4).collect()}
    assert gone == {8: [0, 1, 2]}
    assert len(dedup.deletions(docs, rare_texts=100).collect()) == 8


def test_short_texts_go_however_many_copies_there_are(make_docs):
    one, two = "one line of nine words that many texts are", "a first line of five\nand a second line of six"
    gone = {r._id: r.gone for r in dedup.deletions(make_docs(*[one, two] * 120)).collect()}
    assert gone == {i: [[0], [0, 1]][i % 2] for i in range(2, 240)}


def test_blocks_copied_from_a_later_holder_go(make_docs):
    a, b, c, d = (f"line {x} of the five" for x in "abcd")
    again = "this one comes twice in both of the texts"
    docs = make_docs(
        "\n".join([a, b, c, d]),
        "\n".join([d, c, b, a]),
        "\n".join(["new before", d, c, "", b, a, "new after"]),
        "\n".join(["first it begins with eight words of its own", again, "then the middle has eight words of its own", again]),
        "\n".join(["then the middle has eight words of its own", again, "and an end"]),
    )
    gone = {r._id: r.gone for r in dedup.deletions(docs).collect()}
    assert gone[2] == [1, 2, 4, 5] and gone[4] == [0, 1]


def test_lines_that_repeat_are_compared_with_all_their_places():
    row = {"hub": 0, "n_texts": 2, "n_words": 9}
    rows = [
        row | {"line_no": 0, "hub_line": 5, "times": 1, "hub_lines": [5]},
        row | {"line_no": 1, "hub_line": 1, "times": 2, "hub_lines": [1, 7]},
    ]
    assert dedup.aligned(rows) == {0, 1}


def test_empty_table(no_docs):
    assert dedup.report(no_docs).count() == 0
