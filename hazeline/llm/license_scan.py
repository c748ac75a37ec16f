"""License scans by diagonal voting.

All rolling word k-grams of the documents are joined with the k-grams of license
templates. A hit at word p of a document and word t of a template votes for the
offset p - t: hits of one passage lie on one diagonal, or on neighbouring ones
where a few words were put in or left out. Votes are summed by diagonal,
neighbouring diagonals merge, and the merged span is verified: of its hits, the longest
run that goes forward in the passage and in the template at once counts, each place of
the template once. It must cover most of the template within little more than the
template's length. So repeated or shuffled words of a template are no passage.

Beside the templates stand short base phrases whose places are listed exactly.
Only built-in functions are used. Templates are short wordings and whole headers; they
are broadcast behind a check of their size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm.license_texts import WHOLE

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Wordings by which works are commonly put under a license.
TEMPLATES = [
    *WHOLE,
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the"
            " gnu general public license as published by the free software foundation"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the"
             " gnu lesser general public license as published by the free software foundation"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the"
               " license at"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and"
            " associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"
            " provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
#: Templates of so many characters at most are broadcast.
BROADCAST_CHARS = 4 * 1024 * 1024
GRAM = 3
#: Offsets that differ by no more than this belong to one passage.
SLACK = 3
#: The part of a template's k-grams a passage must have.
MIN_COVER = 0.6

_WORD = r"[0-9a-z\x80-\x{10FFFF}]+"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_WORD), 0)


def _grams(words: Column, k: int) -> Column:
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - k),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]),
    )
    return F.when(F.size(words) >= k, hashes).otherwise(F.array().cast("array<bigint>"))


def _places(words: Column, phrases: dict[str, str]) -> Column:
    """Structs of start and label for each place where a phrase stands, by start."""
    split = {phrase: phrase.split() for phrase in phrases}
    first = sorted({parts[0] for parts in split.values()})

    def label(i: Column) -> Column:
        found = F.lit(None).cast("string")
        for phrase, parts in split.items():
            same = [F.get(words, i + j) == part for j, part in enumerate(parts)]
            found = F.when(reduce(Column.__and__, same), phrases[phrase]).otherwise(found)
        return F.struct(i.alias("start"), found.alias("label"))

    starts = F.filter(
        F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0))), lambda i: F.get(words, i).isin(first)
    )
    return F.filter(F.transform(starts, label), lambda place: place["label"].isNotNull())


def find_spans(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    k: int = GRAM,
    slack: int = SLACK,
    min_cover: float = MIN_COVER,
) -> DataFrame:
    """Passages that follow a template: row, doc_id, label, first, last, cover.

    ``row`` is a hash of a row's id and text; equal rows give their spans once.
    ``first`` and ``last`` are the words where the passage begins and ends. A
    template needs k words at least. Null and empty texts have no spans.
    """
    spark = docs.sparkSession
    listed = spark.createDataFrame(
        [(n, label, text) for n, (label, text) in enumerate(templates)], "template int, label string, wording string"
    )
    grams = listed.select(
        "template", "label", F.posexplode(_grams(F.split("wording", " "), k)).alias("at", "gram")
    ).withColumn("grams", F.count(F.lit(1)).over(Window.partitionBy("template")))
    rows = docs.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", _words(F.col("text")).alias("words"))
    if sum(len(text) for _, text in templates) <= BROADCAST_CHARS:
        grams = F.broadcast(grams)
    hits = (
        rows.select("row", "doc_id", F.posexplode(_grams(F.col("words"), k)).alias("place", "gram"))
        .join(grams, "gram")
        .withColumn("diagonal", F.col("place") - F.col("at"))
    )
    key = ["row", "doc_id", "template"]
    votes = hits.groupBy(*key, "label", "grams", "diagonal").agg(
        F.collect_set("at").alias("ats"), F.min("place").alias("first"), F.max("place").alias("last")
    )
    along = Window.partitionBy(*key).orderBy("diagonal")
    fresh = F.col("diagonal") - F.lag("diagonal").over(along) > slack
    passage = F.sum(F.when(fresh, 1).otherwise(0)).over(along)
    hit = F.transform("ats", lambda at: F.struct(at.alias("at"), (-at - F.col("diagonal")).alias("back")))
    merged = (
        votes.withColumn("passage", passage)
        .groupBy(*key, "label", "grams", "passage")
        .agg(
            F.sort_array(F.flatten(F.collect_list(hit))).alias("hits"),
            F.min("first").alias("first"),
            (F.max("last") + k - 1).alias("last"),
        )
    )
    room = F.col("grams") + k - 1 + 2 * slack
    near = merged.where((F.size("hits") >= min_cover * F.col("grams")) & (F.col("last") - F.col("first") < room))
    cover = _forward(F.col("hits")) / F.col("grams")
    return near.withColumn("cover", cover).where(F.col("cover") >= min_cover).select(
        "row", "doc_id", "label", "first", "last", "cover"
    )


def _forward(hits: Column) -> Column:
    """The most hits that go forward in the passage and in the template at once.

    ``hits`` come by place in the template and, of one place, from the last in the text on,
    so a run of rising places in the text takes each place of the template once. The state
    holds the least end of a run of each length.
    """
    none = F.array().cast("array<int>")

    def step(ends: Column, hit: Column) -> Column:
        place = (-hit["back"]).cast("int")
        below = F.size(F.filter(ends, lambda e: e < place))
        return F.concat(F.slice(ends, F.lit(1), below), F.array(place), F.slice(ends, below + 2, F.size(ends)))

    return F.size(F.aggregate(hits, none, step))


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    k: int = GRAM,
    slack: int = SLACK,
    min_cover: float = MIN_COVER,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, places, spans.

    ``places`` are the exact places of the phrases (start, label), ``spans`` the
    passages found by voting (label, first, last, cover), sorted. Both are empty
    arrays where there is none, also for null and empty texts. Equal rows get equal
    results, null ids are matched as such, an empty table gives an empty table.
    Texts are lower-cased by the full alphabet, which for phrases without the
    letters k and å is the same as lower-casing A to Z.
    """
    found = (
        find_spans(docs, templates, k, slack, min_cover)
        .groupBy(F.col("row").alias("of_row"), F.col("doc_id").alias("of_id"))
        .agg(F.sort_array(F.collect_list(F.struct("label", "first", "last", "cover"))).alias("spans"))
    )
    none = F.array().cast("array<struct<label:string,first:int,last:int,cover:double>>")
    rows = docs.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", _words(F.col("text")).alias("words"))
    base = rows.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), _places(F.col("words"), phrases).alias("places"))
    same = (F.col("row") == F.col("of_row")) & F.col("doc_id").eqNullSafe(F.col("of_id"))
    return base.join(found, same, "left").select("doc_id", "n_words", "places", F.coalesce("spans", none).alias("spans"))
