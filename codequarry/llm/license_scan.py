"""Licence scans by diagonal voting, native.

Every text becomes rolling word 2-grams. Their hashes are joined with the places of the same grams
in licence templates (words are compared too, so a hash collision cannot count). A hit votes for
its diagonal, the gram's place in the text minus its place in the template: a template that stands
in a text in one piece has all its votes on one diagonal, inserted or lost words move the rest to a
neighbouring one. Diagonals at most ``gap`` apart merge, and a merged span is verified by the share
of the template's grams found in it.

The join multiplies a gram by its places in the templates, a small constant, and rows collapse to
one per (text, template, diagonal) before anything is shuffled. The templates are a fixed table of
a few hundred rows, the only thing broadcast.

Defined results: null and wordless texts have no words, no hits and score 0; rows may repeat (equal
rows share one scan and get one result row each); a null id is a value like any other; an empty
table gives an empty result; other columns never matter.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import repeated, texts

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases and their labels.
PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)

# Openings of licence notices, lower-cased words only, at most 64 words each.
NOTICES = (
    ("agpl", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

# Diagonals this far apart belong to one span: up to two words put in or left out at one place.
GAP = 2
# A notice counts from this share of its grams; a phrase has to be complete.
COVERAGE = 0.75

KEY = ("doc_id", "h1", "h2", "n_words")


def templates(
    phrases: tuple[tuple[str, str], ...] = PHRASES, notices: tuple[tuple[str, str], ...] = NOTICES
) -> list[tuple[int, str, bool, list[str]]]:
    """(template, label, is_phrase, words)"""
    rows = [(label, True, text.split()) for label, text in phrases]
    rows += [(label, False, text.split()) for label, text in notices]
    for _, _, words in rows:
        if not 2 <= len(words) <= 64:
            raise ValueError(f"a template has 2 to 64 words: {' '.join(words)}")
    return [(i, *row) for i, row in enumerate(rows)]


def _table(spark: SparkSession, names: str, rows: list[tuple]) -> DataFrame:
    def sql(v: object) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v).lower()

    values = ", ".join("(" + ", ".join(map(sql, r)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def words_of(text: str | Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.regexp_extract_all(F.translate(text, upper, lower), F.lit(WORD), F.lit(0))


def hits(docs: DataFrame, rows: list[tuple[int, str, bool, list[str]]]) -> DataFrame:
    """Votes: one row per (text, template, diagonal) with a bit for each template gram found, and
    one row without template per text that holds how many rows have it (``ends``)."""
    spark = docs.sparkSession
    places = [
        (template, at, words[at], words[at + 1])
        for template, _, _, words in rows
        for at in range(len(words) - 1)
    ]
    grams = _table(spark, "template, at, t0, t1", places).withColumn("gram", F.xxhash64("t0", "t1"))
    worded = texts(docs).select(
        "doc_id",
        F.xxhash64("text").alias("h1"),
        # A second hash with its own seed; together with the id they tell rows apart.
        F.xxhash64(F.lit(1), "text").alias("h2"),
        words_of("text").alias("words"),
    )
    # The last word pairs with null and can never match: it stands for the row itself.
    pairs = F.arrays_zip(
        F.col("words").alias("w0"), F.slice("words", F.lit(2), F.size("words")).alias("w1")
    )
    rolled = worded.select(
        "doc_id", "h1", "h2", F.size("words").cast("long").alias("n_words"), F.posexplode_outer(pairs).alias("pos", "pair")
    ).select(
        *KEY, "pos", F.col("pair.w0").alias("w0"), F.col("pair.w1").alias("w1"), F.xxhash64("pair.w0", "pair.w1").alias("gram")
    )
    on = [
        rolled["gram"] == grams["gram"],
        rolled["w0"] == grams["t0"],
        rolled["w1"] == grams["t1"],
    ]
    return (
        rolled.join(F.broadcast(grams), on, "left")
        .select(
            *KEY,
            "template",
            (F.col("pos") - F.col("at")).cast("long").alias("diagonal"),
            F.expr("shiftleft(1L, at)").alias("vote"),
            F.col("w1").isNull().alias("is_end"),
        )
        .groupBy(*KEY, "template", "diagonal")
        .agg(F.bit_or("vote").alias("votes"), F.count_if("is_end").alias("ends"))
    )


def spans(votes: DataFrame, rows: list[tuple[int, str, bool, list[str]]], gap: int = GAP) -> DataFrame:
    """Neighbouring diagonals merged and measured against their template.

    One row per (text, template, span): label, is_phrase, start, coverage, and for phrases the
    places where they stand complete (n_places, first_word, last_word); a text's row without
    template stays as it is.
    """
    spark = votes.sparkSession
    facts = _table(
        spark,
        "template, label, is_phrase, full",
        [(i, label, phrase, (1 << (len(words) - 1)) - 1) for i, label, phrase, words in rows],
    )
    order = Window.partitionBy(*KEY, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > gap
    found = votes.withColumn(
        "span", F.sum(F.when(apart, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    full = F.col("is_phrase") & (F.col("votes") == F.col("full"))
    place = F.when(full, F.col("diagonal"))
    return (
        found.join(F.broadcast(facts), "template", "left")
        .groupBy(*KEY, "template", "span", "label", "is_phrase", "full")
        .agg(
            F.min("diagonal").alias("start"),
            F.bit_or("votes").alias("votes"),
            F.count_if(full).alias("n_places"),
            F.min(place).alias("first_word"),
            F.max(place).alias("last_word"),
            F.sum("ends").alias("ends"),
        )
        .withColumn("coverage", F.bit_count("votes") / F.bit_count("full"))
    )


def scan(
    docs: DataFrame,
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    notices: tuple[tuple[str, str], ...] = NOTICES,
    gap: int = GAP,
    coverage: float = COVERAGE,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is the best coverage of any template by any span. ``labels`` has the base labels and
    those of notices covered to ``coverage`` or more.
    """
    rows = templates(phrases, notices)
    votes = hits(docs, rows)
    is_base = F.col("n_places") > 0
    is_notice = ~F.col("is_phrase") & (F.col("coverage") >= coverage)
    # A phrase is verified place by place; its span's coverage alone could mix two places.
    worth = F.when(~F.col("is_phrase") | is_base, F.col("coverage")).otherwise(F.lit(0.0))
    whole = spans(votes, rows, gap).groupBy(*KEY).agg(
        F.sum("n_places").alias("n_base"),
        F.min("first_word").alias("first_word"),
        F.max("last_word").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(is_base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(is_base | is_notice, F.col("label")))), ",").alias("labels"),
        F.max(worth).alias("score"),
        F.sum("ends").alias("ends"),
    )
    return repeated(whole, "ends").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )
