"""Small documents with everything that may be odd about them."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names clash with those of results.
CLASHING = "n_words int, score string, kept string, spans int, counts int, items string, class_id int"


def prose(seed: int, n_words: int, per_line: int = 12) -> str:
    """Invented words in lines; the same for the same seed."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioulnrstdm") for _ in range(rng.randint(2, 8))) for _ in range(n_words)]
    lines = [" ".join(words[i : i + per_line]) + "." for i in range(0, n_words, per_line)]
    return "\n".join(lines)


def messy_rows() -> list[tuple]:
    """Nulls, empty, blank, short and long texts, ties, repeated rows, copies."""
    base = prose(1, 120)
    return [
        (1, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, " \n\t\n ", "en", None, 3),
        (6, "one", "en", "a", 3),
        (7, "Ünï çödé ñandú 東京 😀 " * 3 + base[:200], "de", "b", 9),
        (8, prose(2, 30_000), "en", "a", 9),
        (9, prose(3, 40) + "\n" + base + "\n" + prose(4, 40), "en", "a", 9),
        (10, base.replace(".", " !"), "fr", "b", 9),
        (None, prose(5, 60), "en", "a", 9),
        (None, base, "en", "a", 9),
        (-5, prose(6, 60), "en", "c", 9),
    ]
