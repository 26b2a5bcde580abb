"""Licence scans: phrase counts, and diagonal voting against licence templates.

Every run of ``K`` words of every text is hashed; Spark joins all hashes to the places
they have in the templates. Hits of one text and template are summed by diagonal (place
in the text less place in the template); diagonals at most ``NEAR`` apart are one
candidate, as a word put in or left out shifts the rest. A candidate is verified if its
hits cover ``COVER`` of the template's words inside a span of the text not over
``STRETCH`` times the template's length.

Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z folded.
A null text has no words. Repeated rows get equal results; ties are all reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from marlspike.llm import bytetext as B

K, NEAR, COVER, STRETCH = 3, 2, 0.75, 1.5
#: The join broadcasts the templates, whose words are limited in all.
MAX_TEMPLATE_WORDS = 200_000

#: Phrase -> label.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: (label, text): short notices as projects and pages carry them.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
]


def _words(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    raw = B.LOWER[raw]
    starts, ends, _ = B.word_spans(raw, np.array([0, len(raw)]), B.WORD_CHARS)
    return B.word_hashes(raw, starts, ends)


def _hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, text it is in, index of the first word of each text and of the end)."""
    low = B.LOWER[data]
    starts, ends, text = B.word_spans(low, offsets, B.WORD_CHARS)
    return B.word_hashes(low, starts, ends), text, np.searchsorted(text, np.arange(len(offsets)))


def _key(batch: pa.RecordBatch, first: int, last: int, data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """64-bit hash of each whole text."""
    full = np.diff(offsets) > 0
    out = np.zeros(last - first, dtype=np.uint64)
    if full.any():
        out[full] = B.word_hashes(data, offsets[:-1][full], offsets[1:][full])
    return pa.array(out.view(np.int64))


def base_counts(docs: DataFrame, phrases: dict[str, str] = PHRASES, text: str = "text") -> DataFrame:
    """``doc_id, key, n_words, n_base, first_word, last_word, base_labels``: all places of the phrases."""
    sought = [([B.hash_word(w) for w in phrase.split()], label) for phrase, label in phrases.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in B.slices(batch.column(1)):
                words, of, heads = _hashed(data, offsets)
                n = last - first
                places, owners, names = [], [], [set() for _ in range(n)]
                for want, label in sought:
                    m = len(words) - len(want) + 1
                    if m <= 0:
                        continue
                    hit = of[:m] == of[len(want) - 1:]
                    for j, w in enumerate(want):
                        hit &= words[j:j + m] == B.U(w)
                    at = np.flatnonzero(hit)
                    for i in set(of[at].tolist()):
                        names[i].add(label)
                    places.append(at - heads[of[at]])
                    owners.append(of[at])
                place = np.concatenate(places) if places else np.zeros(0, np.int64)
                owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
                count = np.bincount(owner, minlength=n)
                lowest, highest = np.full(n, 2**62), np.full(n, -1)
                np.minimum.at(lowest, owner, place)
                np.maximum.at(highest, owner, place)
                none = count == 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), _key(batch, first, last, data, offsets), pa.array(np.diff(heads)), pa.array(count),
                     pa.array(lowest, mask=none), pa.array(highest, mask=none), pa.array([sorted(x) for x in names], pa.list_(pa.string()))],
                    ["doc_id", "key", "n_words", "n_base", "first_word", "last_word", "base_labels"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(docs["doc_id"], docs[text]).mapInArrow(
        run, f"doc_id {kind}, key long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>")


def grams(docs: DataFrame, k: int = K, text: str = "text") -> DataFrame:
    """``doc_id, key, grams``: the hash of every run of ``k`` words, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in B.slices(batch.column(1)):
                words, of, heads = _hashed(data, offsets)
                h = B.gram_hashes(words, k)
                keep = of[: len(h)] == of[k - 1:] if len(h) else np.zeros(0, bool)
                ends = np.concatenate([[0], np.cumsum(np.maximum(np.diff(heads) - k + 1, 0))])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(h[keep].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), _key(batch, first, last, data, offsets), lists], ["doc_id", "key", "grams"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(docs["doc_id"], docs[text]).mapInArrow(run, f"doc_id {kind}, key long, grams array<bigint>")


def spans(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, k: int = K, text: str = "text") -> DataFrame:
    """``doc_id, key, label, first_word, last_word, coverage`` of every verified span."""
    hashed = [_words(t) for _, t in templates]
    if sum(map(len, hashed)) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of over {MAX_TEMPLATE_WORDS} words in all")
    rows = [(int(h), t, at) for t, words in enumerate(hashed) for at, h in enumerate(B.gram_hashes(words, k).view(np.int64))]
    spark = docs.sparkSession
    places = spark.createDataFrame(rows, "gram long, template int, at int")
    about = spark.createDataFrame([(t, label, len(hashed[t])) for t, (label, _) in enumerate(templates)], "template int, label string, words int")
    seen = grams(docs, k, text).select("doc_id", "key", F.posexplode("grams").alias("place", "gram"))
    hits = seen.join(F.broadcast(places), "gram").withColumn("diagonal", F.col("place") - F.col("at"))
    one = ["doc_id", "key", "template"]
    votes = hits.groupBy(*one, "diagonal").agg(
        F.collect_set("at").alias("ats"), F.min("place").alias("lowest"), F.max("place").alias("highest"))  # at most a template's length
    order = Window.partitionBy(*one).orderBy("diagonal")
    votes = votes.withColumn("fresh", F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > NEAR).cast("int"), F.lit(1)))
    votes = votes.withColumn("candidate", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # neighbouring diagonals share places of the template: at most 1 + words of them can hold new ones
    merged = votes.select(*one, "candidate", "lowest", "highest", F.explode("ats").alias("at")).groupBy(*one, "candidate").agg(
        F.collect_set("at").alias("ats"), F.min("lowest").alias("first_word"), (F.max("highest") + k - 1).alias("last_word"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("ats", lambda a: F.sequence(a, a + (k - 1))))))
    merged = merged.join(F.broadcast(about), "template").withColumn("coverage", covered / F.col("words"))
    return merged.filter(
        (F.col("coverage") >= COVER) & (F.col("last_word") - F.col("first_word") + 1 <= STRETCH * F.col("words") + NEAR)
    ).select("doc_id", "key", "label", "first_word", "last_word", "coverage")


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per document: phrase counts, ``base_labels``, ``labels`` and ``score`` (best coverage of a template, else 0)."""
    base = base_counts(docs, phrases)
    found = spans(docs, templates).groupBy("doc_id", "key").agg(F.collect_set("label").alias("found"), F.max("coverage").alias("score"))
    found = found.select(F.col("doc_id").alias("of"), F.col("key").alias("of_key"), "found", "score")
    joined = base.join(found, base["doc_id"].eqNullSafe(found["of"]) & (base["key"] == found["of_key"]), "left")
    both = F.array_sort(F.array_union("base_labels", F.coalesce("found", F.array().cast("array<string>"))))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
