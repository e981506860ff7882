"""License scan by an exact set-similarity join, with DataFrame functions only.

A text is cut into overlapping blocks of words. A block matches a template if it holds
at least the given share of the template's distinct words; templates marked
``together`` must also stand in it word by word. The words of all templates are ordered
by how many texts hold them, rarest first; other words cannot match and are left out
of the sets. If a block holds o words of a template of m, then the first m - o + 1 words
of the template and the first b - o + 1 of the b ordered words of the block share one
(prefix filter), b is at least o (length filter), and at the first shared word enough
words are left on both sides (positional filter). What passes is counted exactly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.decontamination import words_of
from riskweave.llm.text import fresh
from riskweave.operators.joins import measure, sized_join
from riskweave.sources.workspace import settle

BLOCK = 96
STRIDE = 64  # a run of up to BLOCK - STRIDE + 1 words lies whole in the block it starts in


@dataclass(frozen=True)
class Template:
    """Words of a notice, its label, and the share of its distinct words a block must hold."""

    label: str
    words: str
    share: float = 1.0
    together: bool = True
    base: bool = False

    @property
    def distinct(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(self.words.split()))

    @property
    def needed(self) -> int:
        return math.ceil(self.share * len(self.distinct) - 1e-9)


def _notice(label: str, words: str) -> Template:
    return Template(label, words, share=0.8, together=False)


# Phrases of the contract, then names and opening words of public licenses.
BASE = (
    Template("cc-by", "cc by", base=True),
    Template("gpl", "general public license", base=True),
    Template("reserved", "all rights reserved", base=True),
)
NAMES = (
    Template("apache-2.0", "apache license version 2"),
    Template("bsd", "bsd license"),
    Template("bsd", "2 clause bsd"),
    Template("bsd", "3 clause bsd"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc0", "cc0 1 0"),
    Template("gpl-2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license"),
    Template("mit", "mit license"),
    Template("mpl-2.0", "mozilla public license"),
)
NOTICES = (
    _notice("apache-2.0", "you may not use this file except in compliance with the license "
            "you may obtain a copy of the license at"),
    _notice("bsd", "redistribution and use in source and binary forms with or without modification "
            "are permitted provided that the following conditions are met"),
    _notice("cc0", "to the extent possible under law the author has waived all copyright and related "
            "or neighboring rights to this work"),
    _notice("gpl", "this program is free software you can redistribute it and or modify it under the "
            "terms of the gnu general public license"),
    _notice("isc", "permission to use copy modify and or distribute this software for any purpose with "
            "or without fee is hereby granted"),
    _notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files"),
    _notice("mpl-2.0", "this source code form is subject to the terms of the mozilla public license"),
    _notice("unlicense", "this is free and unencumbered software released into the public domain"),
)
TEMPLATES = BASE + NAMES + NOTICES


def _blocks(words: Column, size: int = BLOCK, stride: int = STRIDE) -> Column:
    """Blocks of an array of words, each with the place of its first word."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)), F.lit(stride))
    return F.transform(
        starts, lambda at: F.struct(at.alias("at"), F.slice(words, at + 1, size).alias("words"))
    )


def _literal(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def token_order(docs: DataFrame, templates: Sequence[Template]) -> list[str]:
    """All words of the templates, those in the fewest texts first."""
    known = sorted({w for t in templates for w in t.distinct})
    each = F.explode(F.array_intersect(words_of(F.col("text")), _literal(known))).alias("word")
    counts = {
        r["word"]: r["n"]  # a row per word of the templates
        for r in docs.select(each).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    return sorted(known, key=lambda w: (counts.get(w, 0), w))


def _index(docs: DataFrame, templates: Sequence[Template], order: list[str]) -> DataFrame:
    """One row per word of each template's prefix: ``rank, place, template...``."""
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for number, t in enumerate(templates):
        ranks = sorted(rank[w] for w in t.distinct)
        phrase = t.words.split()
        for place, r in enumerate(ranks[: len(ranks) - t.needed + 1]):
            rows.append((r, place, number, t.label, t.base, t.together, t.needed, ranks, phrase))
    fields = (
        "rank int, place int, template int, label string, base boolean, together boolean, "
        "needed int, ranks array<int>, phrase array<string>"
    )
    return docs.sparkSession.createDataFrame(rows, fields)


def matching_blocks(
    docs: DataFrame, templates: Sequence[Template] = TEMPLATES, order: list[str] | None = None
) -> DataFrame:
    """``text_key, at, template, label, base, share, n, first, last`` of every match.

    A text is known by its MD5. ``at`` is the place of the block's first word; ``share``
    the part of the template's distinct words it holds; ``n, first, last`` count the
    places where a ``together`` template starts in the block's own stride, 0 otherwise.
    """
    longest = max(len(t.words.split()) for t in templates)
    if longest > BLOCK - STRIDE + 1:
        raise ValueError(f"a template has {longest} words, at most {BLOCK - STRIDE + 1} fit")
    order = order or token_order(docs, templates)
    index = _index(docs, templates, order)
    rank = {w: i for i, w in enumerate(order)}
    starts = sorted(
        {w for t in templates for w in sorted(t.distinct, key=rank.get)[: len(t.distinct) - t.needed + 1]}
    )
    text_key = F.md5(F.col("text").cast("binary")).alias("text_key")
    worded = docs.where(F.col("text").isNotNull()).select(text_key, words_of(F.col("text")).alias("words"))
    likely = worded.where(F.arrays_overlap("words", _literal(starts)))
    own = F.filter(_blocks(F.col("words")), lambda b: F.arrays_overlap(b["words"], _literal(starts)))
    blocks = likely.select("text_key", F.explode(own).alias("b")).select("text_key", "b.*")

    known = _literal(order)
    held = F.transform(
        F.array_intersect("words", known), lambda w: (F.array_position(known, w) - 1).cast("int")
    )
    held_blocks = blocks.withColumn("held", F.array_sort(held))
    tokens = held_blocks.select("*", F.posexplode("held").alias("own_place", "rank"))
    left = F.least(F.size("held") - F.col("own_place"), F.size("ranks") - F.col("place"))
    candidates = (
        tokens.join(F.broadcast(index), "rank")
        .where(F.size("held") >= F.col("needed"))
        .where(left >= F.col("needed"))
        .withColumn("shared", F.array_intersect("held", "ranks"))
        .where((F.array_min("shared") == F.col("rank")) & (F.size("shared") >= F.col("needed")))
    )
    length = F.size("phrase")
    begins = F.sequence(F.lit(0), F.lit(STRIDE - 1))
    here = F.filter(begins, lambda i: F.slice(F.col("words"), i + 1, length) == F.col("phrase"))
    places = F.when(F.col("together"), here).otherwise(F.array().cast("array<int>"))
    placed = candidates.withColumn("places", places)
    matches = placed.where(~F.col("together") | (F.size("places") > 0))
    return (
        matches.select(
            "text_key",
            "at",
            "template",
            "label",
            "base",
            (F.size("shared") / F.size("ranks")).alias("share"),
            F.size("places").cast("bigint").alias("n"),
            (F.col("at") + F.array_min("places")).cast("bigint").alias("first"),
            (F.col("at") + F.array_max("places")).cast("bigint").alias("last"),
        )
        .groupBy("text_key", "at", "template")
        .agg(*[F.first(c).alias(c) for c in ("label", "base", "share", "n", "first", "last")])
    )


def license_labels(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """One row per distinct text with a match: ``text_key, n_base, first_word, last_word,
    base_labels, labels, score``."""
    base = lambda c: F.when(F.col("base"), F.col(c))
    names = lambda c: F.concat_ws(",", F.sort_array(F.collect_set(c)))
    return (
        matching_blocks(docs, templates)
        .groupBy("text_key")
        .agg(
            F.coalesce(F.sum(base("n")), F.lit(0)).alias("n_base"),
            F.min(base("first")).alias("first_word"),
            F.max(base("last")).alias("last_word"),
            names(base("label")).alias("base_labels"),
            names("label").alias("labels"),
            F.max("share").alias("score"),
        )
    )


FOUND = ("n_base", "first_word", "last_word", "base_labels", "labels", "score")


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words`` and the ``FOUND`` columns.

    ``n_base``, ``first_word`` and ``last_word`` count and bound the places of the base
    phrases, ``labels`` are those of all matching templates, ``score`` is the largest
    share of a matching template's words, 0 without one. A NULL or empty text has no
    words, no labels ('') and NULL places. Repeated rows come back repeated; an
    empty table gives no rows; columns named like an added one are replaced.
    """
    found = settle(license_labels(docs.select("text"), templates))
    key = fresh(docs, "_text_key")
    new = [fresh(docs, f"_{c}") for c in FOUND]
    keyed = docs.withColumns(
        {key: F.md5(F.col("text").cast("binary")), "n_words": F.size(words_of(F.col("text"))).cast("bigint")}
    )
    by = [c for c in ("doc_id",) if c in docs.columns]
    joined = sized_join(keyed, found.toDF(key, *new), key, "left", measure(found), salt_by=by or None)
    empty = {"n_base": F.lit(0).cast("bigint"), "base_labels": F.lit(""), "labels": F.lit(""), "score": F.lit(0.0)}
    filled = {c: F.coalesce(F.col(n), empty[c]) if c in empty else F.col(n) for c, n in zip(FOUND, new, strict=True)}
    return joined.withColumns(filled).drop(key, *new)


def license_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words`` and the ``FOUND`` columns for each row of ``docs``."""
    return scan_licenses(docs.select("doc_id", "text")).select("doc_id", "n_words", *FOUND)
