"""License scan by diagonal voting.

Every 2-word run of a text is joined by its hash to the places where the templates have it.  A match votes for the
diagonal text place - template place; the votes are aggregated per text, template and diagonal, neighbouring diagonals are
merged, and a span counts when its votes cover enough of the template.  Texts are not shuffled: the template table has a fixed
size and is broadcast, the votes are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netorigin.llm.columns import let, text_or_empty

GRAM = 2
NEIGHBOUR = 3  # diagonals this near are one span with words put in or left out
COVER = 0.7

#: The base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices of public licenses, as their authors ask to have them written.
NOTICES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
           "documentation files the software to deal in the software without restriction",
    "mit-named": "released under the mit license",
    "apache": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that "
           "the following conditions are met",
    "mpl": "this source code form is subject to the terms of the mozilla public license",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
                  "license as published by the free software foundation",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc": "this work is licensed under a creative commons attribution",
}


def license_words(text: Column) -> Column:
    """Words of ASCII letters, digits and any non-ASCII characters, A-Z in lower case."""
    low = F.translate(text_or_empty(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def templates(spark, texts: dict[str, str]) -> DataFrame:
    rows = []
    for name, t in texts.items():
        w = t.split()
        rows += [(name, len(w) - GRAM + 1, i, " ".join(w[i:i + GRAM])) for i in range(len(w) - GRAM + 1)]
    return spark.createDataFrame(rows, "template string, size int, place int, gram string").withColumn("hash", F.xxhash64("gram"))


def votes(docs: DataFrame, key: list[str], text: str, texts: dict[str, str]) -> DataFrame:
    """(key, template, size, diagonal, cover, first, last): distinct template places that agree on a diagonal.

    Counting distinct places makes repeated rows of one key count once.
    """
    grams = docs.select(*key, F.posexplode(let(license_words(F.col(text)), lambda w: F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - (GRAM - 1), F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1))))).alias("at", "said"))
    hit = grams.join(F.broadcast(templates(docs.sparkSession, texts)), (F.xxhash64("said") == F.col("hash")) & (F.col("said") == F.col("gram")))
    return (hit.groupBy(*key, "template", "size", (F.col("at") - F.col("place")).alias("diagonal"))
            .agg(F.count_distinct("place").cast("int").alias("cover"), F.min("at").alias("first"), (F.max("at") + (GRAM - 1)).alias("last")))


def merged(v: DataFrame, key: list[str]) -> DataFrame:
    """Spans: diagonals of one text and template that lie within `NEIGHBOUR` of the one before are one span."""
    w = Window.partitionBy(*key, "template").orderBy("diagonal")
    new = F.when(F.col("diagonal") - F.lag("diagonal").over(w) <= NEIGHBOUR, 0).otherwise(1)
    island = F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (v.withColumn("new", new).withColumn("island", island).groupBy(*key, "template", "size", "island")
            .agg(F.sum("cover").alias("cover"), F.min("first").alias("first"), F.max("last").alias("last")))


def spans(docs: DataFrame, key: list[str], text: str = "text", notices: dict[str, str] | None = None) -> DataFrame:
    """(key, label, base, first, last, cover): verified places.

    A base phrase counts where its words stand consecutively, that is all its places on one diagonal.  A notice counts where merged
    diagonals cover `COVER` of it or more and are not much longer than it.
    """
    notices = NOTICES if notices is None else notices
    v = votes(docs, key, text, {**{p: p for p in PHRASES}, **notices})
    labels = docs.sparkSession.createDataFrame([*PHRASES.items()], "template string, label string")
    base = v.join(F.broadcast(labels), "template").filter("cover = size").select(
        *key, "label", F.lit(True).alias("base"), "first", "last", F.lit(1.0).alias("cover"))
    rest = merged(v.join(F.broadcast(labels), "template", "left_anti"), key)
    share = F.least(F.col("cover") / F.col("size"), F.lit(1.0))
    rest = rest.filter((share >= COVER) & (F.col("last") - F.col("first") < 2 * F.col("size") + NEIGHBOUR)).select(
        *key, F.col("template").alias("label"), F.lit(False).alias("base"), "first", "last", share.alias("cover"))
    return base.unionByName(rest)


def licenses(docs: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    A null text is empty.  Rows equal in id and text share their spans.  `score` is the best cover of a span, 0 without
    one.
    """
    t = text_or_empty(F.col("text"))
    d = docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).alias("text")).withColumn("_h", F.xxhash64(t))
    found = spans(d, ["doc_id", "_h"], "text").groupBy(F.col("doc_id").alias("_id"), F.col("_h").alias("_k")).agg(
        F.count_if("base").alias("n_base"), F.min(F.when(F.col("base"), F.col("first"))).cast("bigint").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).cast("bigint").alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("b"),
        F.array_sort(F.collect_set("label")).alias("a"), F.max("cover").alias("score"))
    sized = d.select("doc_id", "_h", F.size(license_words(F.col("text"))).cast("bigint").alias("n_words"))
    return sized.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_k")), "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"), "first_word", "last_word",
        F.coalesce(F.array_join("b", ","), F.lit("")).alias("base_labels"), F.coalesce(F.array_join("a", ","), F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
