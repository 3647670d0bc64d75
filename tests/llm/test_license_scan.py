import math
import re

from recordflow.llm import license_scan as scan
from recordflow.llm.common import LOWER, UPPER, WORD

from text_cases import messy_rows, prose


def plain(text):
    words, starts, base = re.findall(WORD, (text or "").translate(str.maketrans(UPPER, LOWER))), [], set()
    for phrase, label in scan.PHRASES.items():
        parts = phrase.split()
        found = [i for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts]
        starts += found
        base |= {label} if found else set()
    labels, score, step, k = set(base), 1.0 if starts else 0.0, scan.BLOCK_WORDS // 2, 0
    while True:
        block = set(words[k * step : k * step + scan.BLOCK_WORDS])
        for label, needed in scan.template_words():
            shared = len(block & needed)
            if shared >= math.ceil(scan.THRESHOLD * len(needed) - 1e-9):
                labels.add(label)
                score = max(score, shared / len(needed))
        if k * step + scan.BLOCK_WORDS >= len(words):
            break
        k += 1
    first, last = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score


NOTICES = [
    "Released under the MIT License.",
    prose(7, 90) + "\nLicensed under the Apache\nLicense, Version 2.0\n" + prose(8, 90),
    "licensed CC BY-NC 4.0, cc by nc cc by nc",
    "Permission is granted, free of charge, to any person obtaining a copy of this software and associated documentation files to deal in the Software without restriction",
    "This work is licensed under the GNU General Public License, version 3.",
    "the license of the public is general",
]


def test_scan_agrees_with_plain_search(spark, messy, make_docs):
    docs = make_docs(*NOTICES)
    got = sorted((tuple(r) for r in scan.scan(docs).collect()), key=repr)
    assert got == sorted(((i, *plain(t)) for i, t in enumerate(NOTICES)), key=repr)
    assert {r[0]: r[6] for r in got}[4] == "gpl"
    got = sorted((tuple(r) for r in scan.scan(messy).collect()), key=repr)
    assert got == sorted(((r[0], *plain(r[1])) for r in messy_rows()), key=repr)


def test_empty_table(no_docs):
    assert scan.scan(no_docs).count() == 0


def test_order_counts_all_documents(make_docs):
    docs = make_docs("mit mit the", "the the the license")
    assert scan.word_order(docs, {"mit", "the", "license", "absent"}) == ["absent", "license", "mit", "the"]
