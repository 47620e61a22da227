"""License statements by diagonal voting.

Every text is cut into words (A-Z in lower case, runs of digits, a-z and non-ASCII characters). The
hashes of all its word pairs are joined to the pairs of the templates; a match votes for a diagonal
(word position less template position). Votes are summed per document, template and diagonal, close
diagonals are merged (a word added or lost moves the rest by one), and a merged span counts if it
covers enough of the template.

A phrase is a template that must be covered whole on one diagonal, so its spans are exactly the places
where its words stand next to each other. Templates are a fixed, small list, so their pairs are
broadcast; texts are scanned once and never shuffled, only votes are.

Defined cases: a null or word-free text has no words, no places and score 0; rows that repeat a doc_id
are answered row by row; a null doc_id is kept; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stream_commerce.llm.shared import ascii_lower, texts

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MERGE = 2
COVERED = 0.7

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# The wording of public license notices.
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "licensed under the creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


#: The places of a template that a span holds are bits of one long.
MOST_WORDS = 64


def _templates(spark, phrases: dict[str, str], notices: list[tuple[str, str]]) -> DataFrame:
    """(template, label, phrase, pairs, words): one row per template of at most 64 words."""
    if any(len(text.split()) > MOST_WORDS for text in [*phrases, *(text for _, text in notices)]):
        raise ValueError(f"a template has more than {MOST_WORDS} words")
    rows = [(i, label, i < len(phrases), text.split()) for i, (text, label) in enumerate(
        [*phrases.items(), *((text, label) for label, text in notices)])]
    return spark.createDataFrame(rows, "template int, label string, phrase boolean, words array<string>").withColumn(
        "pairs", F.size("words") - 1)


def _pairs(hashes: str = "hashes") -> Column:
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + 1)))


def votes(documents: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, n_words, template, diagonal, votes, places, low, high), votes of one diagonal each; places
    has a bit for every template position, low and high are the first and last one. Every text has one more row without template."""
    words = texts(documents, id_col, text_col).select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(WORD), F.lit(0)).alias("words"))
    hashed = words.select("row", "doc_id", F.size("words").alias("n_words"),
                          F.transform("words", lambda x: F.xxhash64(x)).alias("hashes"))
    # Position 0 is a mark that every text has, so texts without any match are not lost.
    mark = F.lit(0).cast("long")
    spots = hashed.select("row", "doc_id", "n_words", F.posexplode(
        F.concat(F.array(mark), _pairs())).alias("spot", "pair"))
    known = templates.select("template", F.transform("words", lambda x: F.xxhash64(x)).alias("hashes"), "pairs").select(
        "template", "pairs", F.posexplode(_pairs()).alias("place", "known")).filter("place < pairs").select(
        "template", "place", "known")
    known = known.unionByName(known.sparkSession.range(1).select(
        F.lit(None).cast("int").alias("template"), F.lit(0).alias("place"), mark.alias("known")))
    hits = spots.join(F.broadcast(known), (F.col("pair") == F.col("known"))
                      & ((F.col("spot") == 0) == F.col("template").isNull()))
    return hits.groupBy(
        "row", "doc_id", "n_words", "template", (F.col("spot") - 1 - F.col("place")).alias("diagonal")
    ).agg(F.count("*").alias("votes"), F.bit_or(F.expr("shiftleft(1L, place)")).alias("places"),
          F.min("place").alias("low"), F.max("place").alias("high"))


def spans(found: DataFrame, templates: DataFrame, merge: int = MERGE, covered: float = COVERED) -> DataFrame:
    """(row, doc_id, n_words, label, phrase, start, cover) of verified spans, and one row with a null
    label per text."""
    about = F.broadcast(templates.select(F.col("template").alias("t"), "label", "phrase", "pairs"))
    known = found.join(about, F.col("template") == F.col("t"), "left")
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    # A phrase is not merged: its words must stand on one diagonal.
    apart = F.when(F.col("phrase"), 1).otherwise(
        (F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along), F.lit(merge + 1)) > merge).cast("int"))
    grouped = known.withColumn("apart", apart).withColumn("group", F.sum("apart").over(along)).groupBy(
        "row", "doc_id", "n_words", "template", "label", "phrase", "pairs", "group").agg(
        F.sum("votes").alias("votes"), F.bit_or("places").alias("places"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min(F.col("diagonal") + F.col("low")).alias("from"), F.min("diagonal").alias("start"))
    # Verified by the different places that stand there: a place that is repeated counts once.
    cover = F.bit_count("places") / F.col("pairs")
    whole = F.when(F.col("phrase"), F.col("votes") == F.col("pairs")).otherwise(
        (cover >= covered) & ((F.col("high") - F.col("low") + 1) / F.col("pairs") >= covered))
    return grouped.filter(F.col("template").isNull() | whole).select(
        "row", "doc_id", "n_words", "label", "phrase", F.when(F.col("phrase"), F.col("start")).otherwise(
            F.col("from")).alias("start"), cover.alias("cover"))


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None,
         notices: list[tuple[str, str]] | None = None, merge: int = MERGE, covered: float = COVERED) -> DataFrame:
    """One row per text: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The base columns speak of the phrases only; labels adds those of the notices; score is the best
    cover of a template, 1 where a phrase stands and 0 without any.
    """
    spark = documents.sparkSession
    templates = _templates(spark, PHRASES if phrases is None else phrases, NOTICES if notices is None else notices)
    rows = spans(votes(documents, templates, id_col, text_col), templates, merge, covered)
    base = F.col("phrase")
    joined = lambda labels: F.array_join(F.array_sort(F.collect_set(labels)), ",")
    return rows.groupBy("row", "doc_id", "n_words").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start").cast("long"))).alias("first_word"),
        F.max(F.when(base, F.col("start").cast("long"))).alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"), joined("label").alias("labels"),
        F.coalesce(F.max(F.when(F.col("label").isNotNull(), F.col("cover"))), F.lit(0.0)).alias("score"),
    ).select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word",
             "base_labels", "labels", "score")
