"""License scans: an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.text import PLAIN_WORD, ascii_lower

# Phrases whose words stand consecutively, and their labels.
BASE_PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
# Notices that the similarity join looks for. At most 32 different words each.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("gpl-notice", "This work is licensed under the GNU General Public License, version"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution ShareAlike license"),
    ("isc", "Permission to use, copy, modify, and distribute this software for any purpose is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)


@dataclass(frozen=True)
class _Template:
    label: str
    words: tuple[str, ...]  # different words, rarest first
    need: int  # words that a block must hold

    @property
    def prefix(self) -> tuple[str, ...]:
        """A block without any of these words holds too few of the rest."""
        return self.words[: len(self.words) - self.need + 1]


def _words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(PLAIN_WORD), F.lit(0))


def _template_words(text: str) -> list[str]:
    return sorted(set(re.findall(PLAIN_WORD, text.lower())))


def word_frequencies(docs: DataFrame, vocabulary: Sequence[str], text_col: str = "text") -> dict[str, int]:
    """How often each word of the templates stands in all documents. Bounded by the templates."""
    words = docs.select(F.explode(_words(F.col(text_col))).alias("word"))
    counts = words.filter(F.col("word").isin(list(vocabulary))).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return dict.fromkeys(vocabulary, 0) | {row["word"]: row["n"] for row in counts.collect()}


def _places(phrase: str) -> Column:
    """Starts of a phrase in the column ``words``."""
    parts = phrase.split()
    there = reduce(Column.__and__, [F.array_contains("words", part) for part in parts])
    last = F.size("words") - len(parts)
    starts = F.filter(
        F.sequence(F.lit(0), last),
        lambda at: reduce(Column.__and__, [F.get("words", at + k) == part for k, part in enumerate(parts)]),
    )
    return F.when(there & (last >= 0), starts).otherwise(F.array().cast("array<int>"))


def scan_licenses(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: Sequence[tuple[str, str]] = BASE_PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = 0.8,
    block_words: int = 64,
) -> DataFrame:
    """``(id_col, n_words, n_base, first_word, last_word, base_labels, labels, score)``, a row for every row of ``docs``.

    A block is ``block_words`` words of a text; blocks start at every half block, so a notice of up
    to half a block lies whole in one. A block has the label of a template when it holds at least
    ``threshold`` of the template's different words. Words are ordered by how often they stand in
    all documents. The prefix filter looks only at blocks with one of a template's rarest words,
    the length filter at blocks with enough of the templates' words, and the positional filter
    wants enough of them from the found word on. The words that remain are counted, so every block
    at the threshold is found.

    ``n_base`` counts all places of the base phrases, ``first_word`` and ``last_word`` are their
    smallest and largest start, null without any. ``score`` is the largest share of a template
    found in a matching block, 1 with a base phrase and 0 without either. A null or empty text has
    no words, no places and empty labels. Rows that repeat an id stay apart, as each row is
    scanned by itself; other columns are not read. An empty table gives no rows.
    """
    half = block_words // 2
    sets = {text: _template_words(text) for _, text in templates}
    if any(not words or len(words) > half for words in sets.values()):
        raise ValueError(f"a template needs 1 to {half} different words")
    vocabulary = sorted({word for words in sets.values() for word in words})
    counts = word_frequencies(docs, vocabulary, text_col) if vocabulary else {}
    order = sorted(vocabulary, key=lambda word: (counts[word], word))
    rank = {word: k for k, word in enumerate(order)}
    index = [
        _Template(label, tuple(sorted(sets[text], key=rank.__getitem__)), max(1, math.ceil(threshold * len(sets[text]) - 1e-9)))
        for label, text in templates
    ]
    rare = sorted({word for template in index for word in template.prefix})

    scanned = docs.select(F.col(id_col).alias("id"), _words(F.col(text_col)).alias("words"))
    hits = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda at: F.get("words", at).isin(rare))
    hits = F.when(F.arrays_overlap("words", F.array(*map(F.lit, rare))), hits) if rare else F.lit(None).cast("array<int>")
    scanned = scanned.select("id", "words", F.coalesce(hits, F.array().cast("array<int>")).alias("hits"))

    ordered = F.array(*map(F.lit, order)) if order else F.array().cast("array<string>")

    def blocks(at: Column) -> Column:
        numbers = F.filter(F.array((at / half).cast("int") - 1, (at / half).cast("int")), lambda number: number >= 0)
        return F.transform(
            numbers,
            lambda number: F.struct(
                F.get("words", at).alias("word"),
                F.array_intersect(ordered, F.slice("words", number * half + 1, block_words)).alias("known"),
            ),
        )

    base_places = [_places(phrase).alias(f"base{k}") for k, (phrase, _) in enumerate(base)]
    probed = scanned.select(
        "id", F.size("words").cast("long").alias("n_words"), F.flatten(F.transform("hits", blocks)).alias("blocks"), *base_places
    )

    def share(template: _Template) -> Column:
        """The largest share of the template in a block that passes the filters."""
        need, words = template.need, F.array(*map(F.lit, template.words))
        near = F.filter(
            "blocks",
            lambda block: block["word"].isin(list(template.prefix))
            & (F.size(block["known"]) >= need)
            & (F.size(block["known"]) - F.array_position(block["known"], block["word"]) + 1 >= need),
        )
        held = F.array_max(F.transform(near, lambda block: F.size(F.array_intersect(words, block["known"]))))
        return F.when(held >= need, held / F.lit(float(len(template.words))))

    shares = [share(template).alias(f"share{k}") for k, template in enumerate(index)]
    found = probed.select("id", "n_words", *[f"base{k}" for k in range(len(base))], *shares)
    all_places = F.flatten(F.array(F.array().cast("array<int>"), *[F.col(f"base{k}") for k in range(len(base))]))
    found = found.withColumn("places", all_places)
    base_labels = [F.when(F.size(f"base{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(base)]
    own_labels = [F.when(F.col(f"share{k}").isNotNull(), F.lit(template.label)) for k, template in enumerate(index)]

    def joined(labels: list[Column]) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(F.lit(None).cast("string"), *labels)))), ",")

    best = F.array_max(F.array(F.lit(0.0), *[F.col(f"share{k}") for k in range(len(index))]))
    return found.select(
        F.col("id").alias(id_col),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined([*base_labels, *own_labels]).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
