"""License scans: phrases, and text blocks that contain most words of a license notice.

A block of a template is a run of consecutive words of the whole text, whatever its line breaks, of at most
``SPREAD`` times the template's words (upper length).  A text matches a template if one of its blocks holds at least
``CONTAINMENT`` of the template's different words, whatever their order.  The text is cut into windows twice as long as
the longest block, which start at each multiple of its length, so every block stands in one of them whole.
The join of windows and templates is exact: words of all
templates are ordered by their frequency in the whole corpus, rarest first; a
window that reaches the threshold shares one of the template's first words in that
order (prefix filter), has enough template words at all (length filter), and enough
of them left behind the first shared one in both orders (positional filter).
Pairs that pass are verified on the full sets of the blocks that begin at the window's template words.  The templates are parameters, so
their words are a table of bounded size.

Words are runs of digits, ASCII letters in lower case and all characters beyond
ASCII.  Everything is done by DataFrame functions.

Defined results: a null or empty text has no words, labels or places and score 0;
rows with equal ``doc_id`` and text get equal results; a null ``doc_id`` is a value like
others; extra columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.core import materialize

#: Phrases whose words must stand consecutively, and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Public license notices and their labels.
TEMPLATES = [
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
            "as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
            "conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc0", "released into the public domain under CC0 1.0 Universal"),
]
#: Share of a template's different words that a block must hold.
CONTAINMENT = 0.9
#: Words of a block at most, as a multiple of the template's.
SPREAD = 1.5
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KEY = ["doc_id", "text_hash"]


def template_words(text: str) -> list[str]:
    return sorted({w for w in re.split(_GAP, text.lower()) if w})


def reach(text: str, spread: float = SPREAD) -> int:
    """Words of the longest block of a template."""
    return math.ceil(spread * len([w for w in re.split(_GAP, text.lower()) if w]) - 1e-9)


def words(text: Column) -> Column:
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lower, _GAP), "")


def word_ranks(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Rank of each template word by its frequency in all texts, the rarest first."""
    spark = docs.sparkSession
    known = spark.createDataFrame([(w,) for w in vocabulary], "word string")
    seen = docs.select(F.explode(words(F.col("text"))).alias("word")).join(F.broadcast(known), "word").groupBy("word").count()
    counts = {r["word"]: r["count"] for r in seen.collect()}  # at most as many rows as the templates have words
    return {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}


def _places(phrase: str, label: str) -> Column:
    """Places of a phrase in the column ``words``."""
    first, *rest = phrase.split(" ")
    at = F.filter(
        F.transform("words", lambda w, i: F.when(w == first, i)),
        lambda i: i.isNotNull() & _all([F.get("words", i + k + 1) == w for k, w in enumerate(rest)]),
    )
    return F.transform(at, lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(c, F.lit(False))
    return out


def _template_table(spark: SparkSession, ranks: dict[str, int], templates: list[tuple[str, str]], containment: float, spread: float) -> DataFrame:
    """A row per template and prefix word."""
    rows = []
    for k, (label, text) in enumerate(templates):
        own = sorted(ranks[w] for w in template_words(text))
        need = math.ceil(containment * len(own) - 1e-9)
        rows += [(k, label, own, need, reach(text, spread), r, p) for p, r in enumerate(own[: len(own) - need + 1])]
    return spark.createDataFrame(rows, "template int, label string, t_ranks array<int>, need int, reach int, rank int, t_at int")


def _held() -> Column:
    """Most different words of the template that one block of it holds; blocks begin at words of the template."""
    own = F.filter("marks", lambda m: F.array_contains("t_ranks", m["rank"]))

    def block(m: Column) -> Column:
        near = F.filter(own, lambda o: (o["at"] >= m["at"]) & (o["at"] < m["at"] + F.col("reach")))
        return F.size(F.array_distinct(F.transform(near, lambda o: o["rank"])))

    return F.array_max(F.transform(own, block))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT, spread: float = SPREAD) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): words, base places and labels, labels and score.

    The score is 1 where a phrase stands, else the greatest containment that reached the threshold, else 0.
    """
    spark = docs.sparkSession
    vocabulary = sorted({w for _, t in templates for w in template_words(t)})
    ranks = word_ranks(docs, vocabulary)
    table = _template_table(spark, ranks, templates, containment, spread)
    prefix = sorted({w for w, r in ranks.items()} & {next(w for w, x in ranks.items() if x == row["rank"]) for row in table.select("rank").distinct().collect()})
    starts = sorted({w for p in PHRASES for w in p.split(" ")[:1]})
    own = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text", words(F.coalesce("text", F.lit(""))).alias("words"))
    hit = F.arrays_overlap("words", F.array(*map(F.lit, sorted({*starts, *prefix}))))
    # places and ranks of the template words of each window that has a prefix word
    rank_of = F.create_map(*[x for w, r in ranks.items() for x in (F.lit(w), F.lit(r))])
    first = F.array(*map(F.lit, prefix))
    longest = max((reach(t, spread) for _, t in templates), default=1)
    windows = F.sequence(F.lit(0), F.greatest(F.size("words") - longest - 1, F.lit(0)), F.lit(longest))
    windows = F.filter(F.transform(windows, lambda i: F.slice("words", i + 1, 2 * longest)), lambda ws: F.arrays_overlap(ws, first))
    marked = lambda w, i: F.struct(i.alias("at"), F.try_element_at(rank_of, w).alias("rank"))
    blocks = F.transform(windows, lambda ws: F.filter(F.transform(ws, marked), lambda m: m["rank"].isNotNull()))
    none = F.array().cast("array<struct<at:bigint,label:string>>")
    places = F.concat(*[_places(p, label) for p, label in PHRASES.items()])
    rows = own.select(
        *_KEY,
        F.size("words").cast("long").alias("n_words"),
        F.when(hit, places).otherwise(none).alias("places"),
        F.when(hit, blocks).alias("blocks"),
    )
    rows = materialize(rows, "licenses")
    block = rows.dropDuplicates(_KEY).select(*_KEY, F.posexplode("blocks").alias("block", "marks"))
    block = block.withColumn("ranks", F.array_sort(F.array_distinct(F.col("marks.rank"))))
    tokens = block.select(*_KEY, "block", "marks", "ranks", F.posexplode("ranks").alias("b_at", "rank"))
    left = 1 + F.least(F.size("ranks") - F.col("b_at") - 1, F.size("t_ranks") - F.col("t_at") - 1)
    pairs = (
        tokens.join(F.broadcast(table), "rank")
        .where((F.size("ranks") >= F.col("need")) & (left >= F.col("need")))
        .where(F.size(F.array_intersect("ranks", "t_ranks")) >= F.col("need"))
        .withColumn("shared", _held())
        .where("shared >= need")
    )
    found = pairs.groupBy(*_KEY).agg(F.collect_set("label").alias("more"), F.max(F.col("shared") / F.size("t_ranks")).alias("part"))
    found = found.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "more", "part")
    out = rows.drop("blocks").join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    base = F.array_distinct(F.col("places.label"))
    every = F.array_union(base, F.coalesce("more", F.array().cast("array<string>")))
    return out.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.col("places.at")).alias("first_word"),
        F.array_max(F.col("places.at")).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("part", F.lit(0.0))).alias("score"),
    )
