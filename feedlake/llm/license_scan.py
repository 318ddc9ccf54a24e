"""License scans: phrases by place, and license texts by an exact set-similarity join.

A text block is a stretch of BLOCK words; blocks begin every half of that, so that any passage as
long as a template lies whole within one. A block holds a template if it has at least a
`threshold` share of the template's distinct words. Words that no template has cannot matter, so
a block is the set of template words in it, ordered as counted over all documents, rarest first.
Three filters then leave few pairs to verify. Prefix: of a template of t words, of which c are
needed, and a block of b, one word is shared by the first t - c + 1 and the first b - c + 1.
Length: b is at least c. Positions: at the first shared word, what follows in the shorter of
both sides must still make up c.

All of it is DataFrame functions.
"""

import math
import re
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.frames import written

# The phrases of the base labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Public license notices, by label.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, "
            "are permitted provided that the following conditions are met"),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International "
              "License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related "
            "or neighboring rights to this work"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the "
            "terms of the GNU General Public License as published by the Free Software "
            "Foundation"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose "
            "with or without fee is hereby granted, provided that the above copyright notice and "
            "this permission notice appear in all copies"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
            "this software and associated documentation files (the Software), to deal in the "
            "Software without restriction"),
    ("mit", "Released under the MIT License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

#: Words of a block; the next begins half as many on. No template is longer than that half.
BLOCK = 128
#: Share of a template's distinct words that a block must have.
THRESHOLD = 0.9

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_words(text: str) -> list[str]:
    """The distinct words of a template, which are of letters and digits, in order."""
    return list(dict.fromkeys(re.findall("[a-z0-9]+", text.lower())))


def needed(size: int, threshold: float) -> int:
    return math.ceil(round(threshold * size, 9))


def spaced(text: Column) -> Column:
    """The words of a text, A-Z in lower case, each after one space; empty if there are none."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    words = F.trim(F.regexp_replace(F.coalesce(lower, F.lit("")), SEPARATORS, " "))
    return F.when(words == "", "").otherwise(F.concat(F.lit(" "), words))


def _spaces(text: Column) -> Column:
    """Words of a spaced text."""
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _words(said: Column) -> Column:
    return F.when(said == "", F.array().cast("array<string>")).otherwise(
        F.split(F.ltrim(said), " ", -1)
    )


def _base(said: Column, phrases: dict[str, str]) -> tuple[dict, dict]:
    """Columns of the phrases that stand in a spaced text: two steps, and what is made of them.

    A phrase may not begin with a word that another, or itself, ends in or holds further on, so
    places never overlap. Most texts hold none of the phrases, and are not split.
    """
    one = "|".join(re.escape(phrase).replace("\\ ", " ") for phrase in phrases)
    pattern = rf" (?:{one})(?= |\z)"
    none = F.array().cast("array<string>")
    any_ = F.lit(False)
    for phrase in phrases:
        any_ = any_ | F.contains(said, F.lit(f" {phrase}"))
    found = F.when(any_, F.regexp_extract_all(said, F.lit(pattern), F.lit(0))).otherwise(none)
    around = F.when(any_, F.split(said, pattern, -1)).otherwise(none)
    labels = [F.when(F.array_contains("found", f" {p}"), label) for p, label in phrases.items()]
    there = F.size("found") > 0
    after = _spaces(F.element_at("found", -1)) + _spaces(F.element_at("around", -1))
    return {"found": found, "around": around}, {
        "n_base": F.size("found").cast("long"),
        "first_word": F.when(there, _spaces(F.element_at("around", 1))),
        "last_word": F.when(there, F.col("n_words") - after),
        "base": F.array_compact(F.array(*labels)),
    }


def word_order(words: DataFrame, vocabulary: list[str]) -> list[str]:
    """`vocabulary`, the words that fewest rows of `words` hold first, counted over all rows.

    A row for each word of the templates comes to the driver, however many documents there are.
    """
    held = F.array_intersect(F.lit(vocabulary), F.col("words"))
    counts = words.select(F.explode(held).alias("word")).groupBy("word").count().collect()
    found = {row["word"]: row["count"] for row in counts}
    return sorted(vocabulary, key=lambda word: (found.get(word, 0), word))


def scan(
    documents: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """What every whole text says of licenses.

    documents: doc_id, text; other columns are ignored. Words are what stands between ASCII
    characters other than letters and digits, A-Z in lower case. Returns for every row: doc_id,
    n_words; of the places where a phrase's words stand one after another n_base, first_word and
    last_word (their smallest and largest start, words counted from 0; null without any) and
    base_labels; labels (those and the ones of templates that a block holds); both distinct,
    sorted and joined by commas; score: 1 where a phrase stands, else the largest share of a
    template that a block holds, 0 if that is below the threshold.

    Null and empty texts have no words, empty labels and score 0; a null doc_id is kept, and
    rows that repeat are rows of their own. Long texts are cut to blocks, all of which are
    looked at; a long text is never a key.
    """
    sets = [(label, template_words(text)) for label, text in templates]
    if max(map(len, (re.findall("[a-z0-9]+", text.lower()) for _, text in templates))) > BLOCK // 2:
        raise ValueError(f"templates may have {BLOCK // 2} words at most")
    said = documents.select(F.col("doc_id").cast("long").alias("doc_id"), spaced("text").alias("said"))
    vocabulary = sorted({word for _, words in sets for word in words})
    order = word_order(said.select(_words(F.col("said")).alias("words")), vocabulary)
    place = {word: i for i, word in enumerate(order)}
    index = []  # (word, template, its place in it, template's size, how many are needed)
    for number, (_, words) in enumerate(sets):
        least = needed(len(words), threshold)
        ordered = sorted(words, key=place.__getitem__)
        first = ordered[: len(words) - least + 1]
        index += [(word, number, at, len(words), least) for at, word in enumerate(first)]

    scanned = written(_blocks(said, phrases, order, index), "scanned")
    found = _join(scanned, sets, index)
    both = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("added", F.array()))))
    phrase = F.when(F.col("n_base") > 0, 1.0).otherwise(0.0)
    return scanned.join(found, "key", "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        F.greatest(phrase, F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def _blocks(said: DataFrame, phrases, order: list[str], index: list[tuple]) -> DataFrame:
    """Per document what the phrases say, and its blocks as ordered sets of template words.

    Blocks without a word of any template's prefix, or with fewer words than any needs, meet no
    template and are not kept; a text without such a word is not cut at all.
    """
    words = said.withColumn("words", _words(F.col("said")))
    steps, base = _base(F.col("said"), phrases)
    rows = words.withColumns({"n_words": F.size("words").cast("long"), **steps})
    rows = rows.withColumns(base)
    prefixes = F.lit(sorted({word for word, *_ in index}))
    least = min(entry[4] for entry in index)
    step = BLOCK // 2
    last = F.greatest(F.ceil(F.col("n_words") / step) - 2, F.lit(0)).cast("int")

    def block(number: Column) -> Column:
        return F.array_intersect(F.lit(order), F.slice("words", number * step + 1, F.lit(BLOCK)))

    cut = F.filter(
        F.transform(F.sequence(F.lit(0), last), block),
        lambda held: (F.size(held) >= least) & F.arrays_overlap(held, prefixes),
    )
    likely = F.arrays_overlap("words", prefixes)
    none = F.array().cast("array<array<string>>")
    return rows.select(
        F.monotonically_increasing_id().alias("key"),
        "doc_id",
        "n_words",
        *base,
        F.when(likely, cut).otherwise(none).alias("blocks"),
    )


def _join(scanned: DataFrame, sets, index: list[tuple]) -> DataFrame:
    """Per document (key) the labels of the templates its blocks hold, and the largest share."""
    spark = scanned.sparkSession
    # As many rows as the templates have words in their prefixes, whatever the documents hold.
    names = "word string, template int, at int, size int, least int"
    prefixes = spark.createDataFrame(index, names).join(
        spark.createDataFrame(
            [(i, label, words) for i, (label, words) in enumerate(sets)],
            "template int, label string, wanted array<string>",
        ),
        "template",
    )
    blocks = scanned.select("key", F.explode("blocks").alias("held"))
    begun = blocks.select("key", "held", F.posexplode("held").alias("position", "word"))
    held = F.size("held")
    left = F.least(held - F.col("position"), F.col("size") - F.col("at"))
    met = begun.join(F.broadcast(prefixes), "word").where(
        (held >= F.col("least"))
        & (F.col("position") <= held - F.col("least"))
        & (left >= F.col("least"))
    )
    pairs = met.select("key", "label", "size", "least", "held", "wanted")
    shared = F.size(F.array_intersect("held", "wanted"))
    verified = pairs.withColumn("shared", shared).where("shared >= least")
    return verified.groupBy("key").agg(
        F.collect_set("label").alias("added"),
        F.max(F.col("shared") / F.col("size")).alias("share"),
    )
