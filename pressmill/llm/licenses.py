"""License scans by diagonal voting.

Rolling hashes of k words of every document are joined by Spark to the positions of the same hashes in license
templates. A meeting votes for the diagonal (document position less template position). Neighbouring diagonals, a few
words inserted or lost apart, are merged; a merged span counts if its votes cover enough of the template's words within
a span of about the template's length.

Python makes only the hashes: each document gives one array, led by a marker that meets the marker row of the template
table, so that documents without votes stay. The templates are a fixed list, hence the broadcast.

Defined results: a null text has no words, no labels, null first and last word and score 0; repeated rows each get a
row; texts of fewer than k words have no votes; without rows there are none.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressmill.llm import words as W
from pressmill.session import materialize

GRAM = 4
NEAR = 3
COVERED = 0.8
STRETCH = 1.3
#: score of a document in which only a phrase was found
PHRASE_SCORE = 0.5
MARKER = 0

# Phrases with their labels, and notices of public licenses.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
TEMPLATES = (
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
                " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with"
                   " the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
            " files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use,"
            " copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
            " following conditions are met"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
)


def grams_of(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of k words from each word on, 0 where the text ends before; bounds as ``first``)."""
    if len(h) < k:
        return np.zeros(len(h), np.int64), first
    total = np.zeros(len(h), np.uint64)
    m = len(h) - k + 1
    for j in range(k):
        total[:m] = total[:m] * np.uint64(0x9E3779B97F4A7C15) + h[j:j + m]
    total = W.mixed(total) | np.uint64(1)  # never the marker
    last = np.repeat(first[1:], np.diff(first))
    total[np.arange(len(h)) + k > last] = np.uint64(2)  # even: meets no gram
    return total.view(np.int64), first


def _phrase_hashes(phrases) -> list[tuple[np.ndarray, str]]:
    return list(zip(W.hash_texts([p for p, _ in phrases], W.ALNUM), [label for _, label in phrases]))


def _scan(k: int, phrases):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _phrase_hashes(phrases)
        for batch in batches:
            for low, high, data, bounds in W.slabs(batch.column(1)):
                h, first = W.hashed(data, bounds, W.ALNUM)
                n = high - low
                places, labels = [], []
                for terms, _ in wanted:
                    at = np.flatnonzero(h == terms[0])
                    for j in range(1, len(terms)):
                        at = at[at + j < len(h)]
                        at = at[h[at + j] == terms[j]]
                    doc = np.searchsorted(first, at, "right") - 1
                    at = at[at + len(terms) <= first[doc + 1]]
                    places.append(at)
                    labels.append(np.searchsorted(first, at, "right") - 1)
                at, doc = np.concatenate(places), np.concatenate(labels)
                kind = np.repeat(np.arange(len(wanted)), [len(p) for p in places])
                count = np.bincount(doc, minlength=n)
                least, most = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                np.minimum.at(least, doc, at - first[doc])
                np.maximum.at(most, doc, at - first[doc])
                has = np.zeros((n, len(wanted)), bool)
                has[doc, kind] = True
                grams, _ = grams_of(h, first, k)
                marked = np.insert(grams, first[:-1], MARKER)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, n), pa.array(np.diff(first), pa.int64()), pa.array(count, pa.int64()),
                    pa.array(least, pa.int64(), mask=count == 0), pa.array(most, pa.int64(), mask=count == 0),
                    pa.array([[wanted[j][1] for j in np.flatnonzero(row)] for row in has], pa.list_(pa.string())),
                    W.lists(marked, first + np.arange(n + 1), pa.int64()),
                ], ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "grams"])
    return run


def template_grams(spark: SparkSession, templates=TEMPLATES, k: int = GRAM) -> DataFrame:
    """(gram, template, template_pos, template_words, label), and the marker row."""
    rows = [(MARKER, -1, 0, 0, None)]
    for number, (label, h) in enumerate(zip([x for x, _ in templates], W.hash_texts([t for _, t in templates], W.ALNUM))):
        grams, _ = grams_of(h, np.array([0, len(h)]), k)
        rows += [(int(g), number, pos, len(h), label) for pos, g in enumerate(grams[:max(0, len(h) - k + 1)].tolist())]
    return spark.createDataFrame(rows, "gram long, template int, template_pos int, template_words int, label string")


def license_labels(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES, k: int = GRAM) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, and spans: an array of verified
    (label, first_word, end_word, covered)."""
    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("id"), W.utf8(text_col).alias("body"))
    scanned = read.mapInArrow(_scan(k, phrases), f"id {kind}, n_words long, n_base long, first_word long, last_word long,"
                              " base_labels array<string>, grams array<long>")
    numbered = scanned.withColumn("row", F.monotonically_increasing_id())
    every = numbered.select("row", "id", "n_words", "n_base", "first_word", "last_word", "base_labels", F.posexplode("grams").alias("pos", "gram"))
    met = materialize(every.join(F.broadcast(template_grams(docs.sparkSession, templates, k)), "gram").drop("gram"), "votes")
    votes = met.where("template >= 0").select("row", "template", "label", "template_words", "template_pos", (F.col("pos") - 1).alias("pos"))
    votes = votes.withColumn("diagonal", F.col("pos") - F.col("template_pos"))
    by = ["row", "template", "label", "template_words"]
    diagonals = votes.groupBy(*by, "diagonal").agg(F.collect_set("template_pos").alias("places"), F.min("pos").alias("start"), F.max("pos").alias("last"))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > NEAR, F.lit(True))
    merged = diagonals.withColumn("apart", apart.cast("int")).withColumn("span", F.sum("apart").over(order)).groupBy(*by, "span").agg(
        F.array_distinct(F.flatten(F.transform(F.flatten(F.collect_list("places")), lambda p: F.sequence(p, p + k - 1)))).alias("words"),
        F.min("start").alias("first_word"), (F.max("last") + k).alias("end_word"))
    covered = F.size("words") / F.col("template_words")
    verified = merged.where((covered >= COVERED) & (F.col("end_word") - F.col("first_word") <= STRETCH * F.col("template_words") + 1))
    spans = verified.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        "label", "first_word", "end_word", covered.alias("covered")))).alias("spans"))
    rows = met.where("template < 0").select("row", F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels")
    none = F.array().cast("array<struct<label:string,first_word:int,end_word:int,covered:double>>")
    return rows.join(spans, "row", "left").drop("row").withColumn("spans", F.coalesce("spans", none))
