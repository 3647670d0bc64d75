"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a window of ``BLOCK_WORDS`` words, taken at every half of it, so a notice of up to
half that length lies whole in a block however its lines are broken. A block matches a template
if it holds at least ``THRESHOLD`` of the template's distinct words. The words of the templates
are ordered by how often they come in the whole corpus, rarest first, and blocks are reduced to
them. A match then shares a word within short prefixes of both (prefix filter), the block has
enough words (length filter), and what follows the shared word can still reach the threshold
(position filter). Only such pairs are verified on their whole sets.

Templates are a small fixed list, so their prefix index is broadcast: at most
``MAX_TEMPLATE_WORDS`` words, checked.

Besides, the places of fixed phrases are counted. Null and empty texts have no words and no
labels; repeated rows and null IDs get their results like others; an empty table gives an empty
result. Columns of the results' names are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from recordflow.llm.common import UPPER, LOWER, WORD, attach, joined_text, keyed, words

BLOCK_WORDS = 128
THRESHOLD = 0.9
MAX_TEMPLATE_WORDS = 20_000

# The phrases whose places are counted, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Public license notices, as texts carry them.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl", "licensed under the GNU General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
]


def template_words(templates=TEMPLATES) -> list[tuple[str, set[str]]]:
    """Label and distinct words of every template."""
    lower = str.maketrans(UPPER, LOWER)
    return [(label, set(re.findall(WORD, text.translate(lower)))) for label, text in templates]


def word_order(docs: DataFrame, vocabulary: set[str], text_column: str = "text") -> list[str]:
    """The vocabulary, rarest in the whole corpus first; equally frequent words by themselves."""
    found = (
        docs.select(F.explode_outer(words(F.col(text_column))).alias("word"))
        .filter(F.col("word").isin(*sorted(vocabulary)))
        .groupBy("word")
        .count()
        .collect()
    )
    times = {r["word"]: r["count"] for r in found}
    return sorted(vocabulary, key=lambda w: (times.get(w, 0), w))


def blocks(docs: DataFrame, order: list[str], block_words: int = BLOCK_WORDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_id, _print, block, tokens``: the template words of each block, rarest first."""
    step = block_words // 2
    vocabulary = F.array(*[F.lit(w) for w in order])
    last = F.greatest(F.lit(0), F.ceil((F.size("_words") - block_words) / step)).cast("int")

    def tokens(k: Column) -> Column:
        return F.array_intersect(vocabulary, F.slice("_words", k * step + 1, block_words))

    return (
        keyed(docs, id_column, text_column)
        .select("_id", "_print", words(F.col("_text")).alias("_words"))
        .select("_id", "_print", F.posexplode_outer(F.transform(F.sequence(F.lit(0), last), tokens)).alias("block", "tokens"))
    )


def matches(
    docs: DataFrame,
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
    block_words: int = BLOCK_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``_id, _print, block, template, label, containment`` of every block and template that match."""
    sets = template_words(templates)
    vocabulary = set().union(*[s for _, s in sets])
    total = sum(len(s) for _, s in sets)
    if total > MAX_TEMPLATE_WORDS:
        raise ValueError(f"{total} template words; at most {MAX_TEMPLATE_WORDS} may be broadcast")
    order = word_order(docs, vocabulary, text_column)
    rank = {w: k for k, w in enumerate(order)}
    rows, least = [], math.inf
    for number, (label, found) in enumerate(sets):
        ordered = sorted(found, key=rank.__getitem__)
        need = math.ceil(threshold * len(ordered) - 1e-9)
        least = min(least, need)
        for place, word in enumerate(ordered[: len(ordered) - need + 1]):
            rows.append((word, number, label, place, len(ordered), need, ordered))
    index = docs.sparkSession.createDataFrame(
        rows, "word string, template int, label string, place int, size int, need int, template_words array<string>"
    )
    found = blocks(docs, order, block_words, id_column, text_column).filter(F.size("tokens") >= least)
    prefix = F.slice("tokens", 1, F.size("tokens") - least + 1)
    probes = found.select("_id", "_print", "block", "tokens", F.posexplode_outer(prefix).alias("at", "_word"))
    size = F.size("tokens")
    fits = (
        (F.col("_word") == F.col("word"))
        & (size >= F.col("need"))
        & (F.col("at") <= size - F.col("need"))
        & (F.least(size - F.col("at"), F.col("size") - F.col("place")) >= F.col("need"))
    )
    shared = F.size(F.array_intersect("template_words", "tokens"))
    return (
        probes.join(F.broadcast(index), fits)
        .withColumn("_shared", shared)
        .filter(F.col("_shared") >= F.col("need"))
        .select("_id", "_print", "block", "template", "label", (F.col("_shared") / F.col("size")).alias("containment"))
        .distinct()
    )


def phrase_starts(phrase: str) -> Column:
    """Word numbers, from 0, at which a phrase stands in ``_words``; ``_joined`` is their text."""
    parts = phrase.split(" ")
    here = lambda i: reduce(
        lambda a, b: a & b, [F.get("_words", i + k) == w for k, w in enumerate(parts)]
    )
    starts = F.filter(F.sequence(F.lit(0), F.size("_words") - len(parts)), lambda i: F.coalesce(here(i), F.lit(False)))
    none = F.expr("cast(array() as array<int>)")
    return F.when(F.col("_joined").contains(f" {phrase} "), starts).otherwise(none)


def scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    id_column: str = "doc_id",
    text_column: str = "text",
    **options,
) -> DataFrame:
    """``doc_id`` with the places of phrases, the labels of phrases and templates, and a score.

    The score is 1 where a phrase stands, else the largest containment of a template that
    matches, else 0.
    """
    found = (
        matches(docs, id_column=id_column, text_column=text_column, **options)
        .groupBy("_id", "_print")
        .agg(F.collect_set("label").alias("_template_labels"), F.max("containment").alias("_containment"))
    )
    every = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("_text"), words(F.col(text_column)).alias("_words"))
    joined = every.withColumn("_joined", F.concat(F.lit(" "), F.array_join("_words", " "), F.lit(" ")))
    starts = joined.select("doc_id", "_text", F.size("_words").cast("long").alias("n_words"), F.array(*[phrase_starts(p) for p in phrases]).alias("_starts"))
    labels = F.array(*[F.lit(label) for label in phrases.values()])
    every_start = F.flatten("_starts")
    base = F.transform(F.filter(F.arrays_zip(F.col("_starts").alias("s"), labels.alias("l")), lambda x: F.size(x["s"]) > 0), lambda x: x["l"])
    based = starts.select(
        "doc_id",
        "_text",
        "n_words",
        F.size(every_start).cast("long").alias("n_base"),
        F.array_min(every_start).cast("long").alias("first_word"),
        F.array_max(every_start).cast("long").alias("last_word"),
        base.alias("_base"),
    )
    more = F.coalesce("_template_labels", F.expr("cast(array() as array<string>)"))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("_containment", F.lit(0.0)))
    return attach(based, found, "doc_id", "_text").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        joined_text(F.col("_base")).alias("base_labels"),
        joined_text(F.concat("_base", more)).alias("labels"),
        score.alias("score"),
    )
