import random

from recordflow.llm import substring_dedup as dedup

from text_cases import messy_rows, prose


def plain(rows):
    """Removed spans of every row, by going through the documents in order."""
    seen, out = {}, []
    for key in sorted({(r[0], r[1] or "") for r in rows}, key=lambda k: (k[0] is None, k[0] or 0, k[1])):
        for start, _, digest in dedup.digests(key[1]):
            if digest is not None:
                place = (key[0] is None, key[0] or 0, start)
                seen[digest] = min(seen.get(digest, place), place)
    for i, text, *_ in rows:
        spans = [(a, b) for a, b, d in dedup.digests(text or "") if d is not None and (i is None, i or 0, a) > seen[d]]
        out.append((i, ",".join(f"{a}-{b}" for a, b in spans), dedup.keep(text or "", spans)))
    return sorted(out, key=repr)


def test_dedup_agrees_with_plain_search(messy):
    got = dedup.dedup(messy)
    assert set(got.columns) == {*messy.columns, "removed_spans"}
    found = sorted(((r.doc_id, ",".join(f"{s.start}-{s.stop}" for s in r.removed_spans or []), r.text or "") for r in got.collect()), key=repr)
    assert found == plain(messy_rows())


def test_short_units_go_with_the_long_one_before(make_docs):
    passage = "A passage of more than six words stands here. So it is. Yes. And it ends with another long sentence."
    docs = make_docs(passage, f"Something else before. {passage} After.", "So it is. Yes.", "Yes. " + prose(9, 30))
    kept = {r.doc_id: r.text for r in dedup.dedup(docs).collect()}
    assert kept[0] == passage and kept[2] == "So it is. Yes."
    assert "passage" not in kept[1] and "Yes" not in kept[1] and kept[1].startswith("Something else before.")
    assert kept[3] == "Yes. " + prose(9, 30)


def test_repeated_runs_of_short_units_go(make_docs):
    listed = "\n".join(f"item {i}!" for i in range(30))
    verse = "Row one. Two here. Now three. And four. Five. Six it is. "
    line = "東京都は日本の首都であり人口が最も多い都市である"
    docs = make_docs(
        listed,
        listed,
        f"{verse}{prose(21, 24)}\n{line}\n",
        f"{prose(22, 24)}\n{verse}{prose(23, 24)}",
        f"Aha. {prose(24, 24)}",
        f"Aha. {prose(24, 24)}",
        "two words",
        "two words",
        f"{prose(25, 24)}\n{line}\n{prose(26, 24)}",
    )
    kept = {r.doc_id: r.text for r in dedup.dedup(docs).collect()}
    assert kept[0] == listed and kept[1] == kept[5] == kept[7] == ""
    assert kept[3] == f"{prose(22, 24)}\n{prose(23, 24)}"
    assert kept[4].startswith("Aha.") and kept[6] == "two words"
    assert kept[8] == f"{prose(25, 24)}\n{prose(26, 24)}"


def covered(texts, min_words=dedup.MIN_WORDS):
    """Units of each text that lie in any long enough run that occurred before, by trying all runs."""
    seen, out = {}, []
    for number, text in enumerate(texts):
        cut = [u for u in dedup.UNIT.finditer(text) if u[0].strip()]
        words = [u[0].lower().split() for u in cut]
        gone = set()
        for i in range(len(cut)):
            for j in range(i, len(cut)):
                if sum(map(len, words[i : j + 1])) >= min_words:
                    first, stop = seen.setdefault(str(words[i : j + 1]), ((number, i), j + 1))
                    if (number, i) > first and not (number == first[0] and i < stop):
                        gone.update(range(i, j + 1))
        out.append([cut[i].span() for i in sorted(gone)])
    return out


def test_runs_agree_with_all_runs(make_docs):
    rng = random.Random(5)
    units = [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) + ". " for _ in range(9)]
    texts = ["".join(rng.choice(units) for _ in range(rng.randint(1, 9))) for _ in range(40)]
    texts = [t for t in texts if len(t.split()) >= dedup.MIN_WORDS]
    got = {r.doc_id: [tuple(s) for s in r.removed_spans or []] for r in dedup.dedup(make_docs(*texts)).collect()}
    assert [got[i] for i in range(len(texts))] == covered(texts)


def test_overlapping_repeats_leave_one_whole(make_docs):
    kept = dedup.dedup(make_docs("Yes! " * 20)).collect()[0].text
    assert kept == "Yes! " * 6


def test_empty_table(no_docs):
    assert dedup.report(no_docs).count() == 0
