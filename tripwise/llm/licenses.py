"""License scans by diagonal voting.

Templates are phrases and notices.  Every rolling word k-gram of every text is joined by
hash to the templates' grams; a hit at word p of the text and word t of the template
votes for the diagonal p - t.  Neighbouring diagonals, between which words were put in
or left out, are merged; a merged span counts if the template's words that its votes
cover verify it: all of a phrase, or a large share of a notice that stand close together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripwise.llm.common import gram_hashes, text_slices, written

#: Words of a gram (all words of a shorter template).
GRAM_WORDS = 3
#: Share of a template's words that a span must hold, and share of a span's words that must be the template's.
MIN_SHARE, MIN_DENSITY = 0.7, 0.4
#: Votes of a diagonal that counts (all votes of a shorter template).
MIN_VOTES = 2
#: Merged diagonals are this share of the template's words apart at most, and so many words.
SHIFT_SHARE, MAX_SHIFT = 0.25, 8
#: More grams of templates than this are joined by a shuffle.
MAX_BROADCAST_GRAMS = 1 << 18


@dataclass(frozen=True)
class Template:
    """A phrase (``base``) that counts where all its words stand, or a notice."""

    label: str
    text: str
    base: bool = False


# Phrases of the base scan, and opening sentences of common licenses.
PHRASES = (
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
)
NOTICES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
             "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
             "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
             "conditions"),
    Template("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License "
             "at http://www.apache.org/licenses/LICENSE-2.0"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
             "option) any later version"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
             "that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
             "was not distributed with this file, You can obtain one at"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
    Template("cc-by", "licensed under CC BY 4.0"),
    Template("cc-by-sa", "licensed under CC BY-SA 4.0"),
    Template("cc-by-nc", "licensed under CC BY-NC 4.0"),
    Template("cc0", "dedicated to the public domain under CC0 1.0"),
)
TEMPLATES = PHRASES + NOTICES

#: The gram that every text has, so that texts without a hit keep a row; template -1 is its own.
_MARK = xxhash.xxh3_64_intdigest(b"every text") - (1 << 63)
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[:0x30] = _BYTES[0x3A:0x41] = _BYTES[0x5B:0x61] = _BYTES[0x7B:0x80] = 0x20
_BYTES[0x41:0x5B] += 0x20


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words, offsets of each text's words): ASCII digits, lower-cased letters and all that is not ASCII."""
    _, ends, data = texts.buffers()
    if len(texts) and data is not None:
        ends = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        own = _BYTES[np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]]
        texts = pa.Array.from_buffers(texts.type, len(texts), [None, pa.py_buffer(ends - ends[0]), pa.py_buffer(own)])
    lists = pc.ascii_split_whitespace(texts)
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    words = lists.flatten()
    offsets = offsets - offsets[0]
    real = np.asarray(pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False), bool)
    if not real.all():  # what separates words at either end leaves empty ones
        before = np.concatenate([[0], np.cumsum(real)])
        offsets, words = before[offsets], words.filter(pa.array(real))
    return words, offsets


def word_hashes(words: pa.Array) -> np.ndarray:
    coded = words.dictionary_encode()
    of = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return of[np.asarray(coded.indices, dtype=np.int64)] if len(of) else np.zeros(0, np.uint64)


def template_words(t: Template) -> list[str]:
    return split_words(pa.array([t.text], pa.large_string()))[0].to_pylist()


def template_shift(n_words: int) -> int:
    """The largest step between merged diagonals."""
    return min(MAX_SHIFT, int(SHIFT_SHARE * n_words))


def template_grams(spark: SparkSession, templates: Sequence[Template]) -> tuple[DataFrame, list[int]]:
    """(gram, template, t, k, label, base, size, shift) of all templates and of the mark, and the distinct k."""
    rows, sizes = [(_MARK, -1, 0, 0, "", False, 0, 0)], set()
    for no, t in enumerate(templates):
        words = split_words(pa.array([t.text], pa.large_string()))[0]
        if not len(words):
            raise ValueError(f"the template of {t.label} has no word")
        k = min(GRAM_WORDS, len(words))
        sizes.add(k)
        rows += [(int(g), no, at, k, t.label, t.base, len(words), template_shift(len(words)))
                 for at, g in enumerate(gram_hashes(word_hashes(words), k).view(np.int64))]
    grams = spark.createDataFrame(rows, "gram long, template int, t int, k int, label string, base boolean, size int, shift int")
    return (F.broadcast(grams) if len(rows) <= MAX_BROADCAST_GRAMS else grams), sorted(sizes)


def text_grams(docs: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """(doc_id, node, n_words, grams): the mark and all rolling grams of each size in turn; node is the text's md5."""
    sizes = tuple(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            words, offsets = split_words(texts)
            counts, hashes = np.diff(offsets), word_hashes(words)
            each = [np.maximum(counts - k + 1, 0) for k in sizes]
            ends = np.concatenate([[0], np.cumsum(1 + sum(each))])
            flat = np.empty(ends[-1], np.int64)
            flat[ends[:-1]] = _MARK
            at = ends[:-1] + 1
            for k, n in zip(sizes, each, strict=True):
                inside = np.repeat(offsets[:-1], n) + _steps(n)
                flat[np.repeat(at, n) + _steps(n)] = gram_hashes(hashes, k).view(np.int64)[inside]
                at = at + n
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(counts), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)],
                names=["doc_id", "node", "n_words", "grams"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", F.unhex(F.md5(text)).alias("node"), text.alias("text")).mapInArrow(
        run, f"doc_id {dict(docs.dtypes)['doc_id']}, node binary, n_words long, grams array<long>")


def _steps(n: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count."""
    ends = np.cumsum(n)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - n, n)


def hits(docs: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """(doc_id, node, n_words, template, t, k, label, base, size, shift, p, copies): each vote once, with the rows that cast it."""
    grams, sizes = template_grams(docs.sparkSession, templates)
    every = text_grams(docs, sizes).select("doc_id", "node", "n_words", F.posexplode("grams").alias("at", "gram"))
    found = every.join(grams, "gram")
    before: Column = F.lit(0).cast("long")
    for k in sizes:  # a gram of k words stands behind all smaller ones
        before = before + F.when(F.col("k") > k, F.greatest(F.lit(0), F.col("n_words") - (k - 1))).otherwise(0)
    found = found.withColumn("p", F.col("at") - 1 - before)
    key = ["doc_id", "node", "n_words", "template", "t", "k", "label", "base", "size", "shift", "p"]
    return found.groupBy(*key).agg(F.count("*").alias("copies"))


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words long, spans array<struct<start, end, label, base, share>>): one row for each row of ``docs``.

    Words are runs of ASCII digits, letters (lower-cased) and characters that are not
    ASCII, numbered from 0.  A span [start, end) of a base template holds all its words in
    a row; that of a notice covers a share of at least MIN_SHARE of its words, which are at
    least MIN_DENSITY of the span's.  Spans are ordered; without one the array is empty.
    Null texts are empty; repeated rows are all returned; null ids are ids like others;
    columns other than doc_id and text play no part.
    """
    doc = ["doc_id", "node", "n_words"]
    votes = written(hits(docs, templates), "license-votes")  # read twice below
    found = votes.filter("template >= 0").withColumn("diagonal", F.col("p") - F.col("t"))
    kind = ["template", "k", "label", "base", "size", "shift"]
    lines = found.groupBy(*doc, *kind, "diagonal").agg(F.collect_set("t").alias("ts"), F.min("p").alias("first"),
                                                       F.max("p").alias("last"))
    lines = lines.filter(F.size("ts") >= F.least(F.lit(MIN_VOTES), F.col("size") - F.col("k") + 1))
    along = Window.partitionBy("doc_id", "node", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > F.col("shift")
    lines = lines.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
    lines = lines.withColumn("merged", F.sum("new").over(along))
    spans = lines.groupBy(*doc, *kind, "merged").agg(
        F.flatten(F.collect_list("ts")).alias("ts"), F.min("first").alias("start"), (F.max("last") + F.col("k")).alias("end"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("ts", lambda t: F.sequence(t, t + F.col("k") - 1)))))
    spans = spans.withColumn("covered", covered)
    share = F.col("covered") / F.col("size")
    whole = F.when(F.col("base"), F.col("covered") == F.col("size")).otherwise(
        (share >= MIN_SHARE) & (F.col("covered") >= F.lit(MIN_DENSITY) * (F.col("end") - F.col("start"))))
    verified = spans.filter(whole).select("doc_id", "node", F.lit(0).cast("long").alias("copies"), "n_words", F.struct(
        F.col("start"), F.col("end"), "label", "base", share.alias("share")).alias("span"))
    marks = votes.filter("template < 0").select("doc_id", "node", "copies", "n_words", F.lit(None).cast(
        verified.schema["span"].dataType).alias("span"))
    # a text has many spans at most in proportion to its words; the marks tell how many rows share id and text
    rows = marks.unionByName(verified).groupBy("doc_id", "node").agg(
        F.max("n_words").alias("n_words"), F.sum("copies").alias("copies"), F.array_sort(F.collect_list("span")).alias("spans"))
    once = rows.select("doc_id", "n_words", "spans", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return once.select("doc_id", "n_words", "spans")


def labels_of(spans: Column) -> Column:
    """Distinct labels, sorted and comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")


def summary(scanned: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of ``scan``'s rows."""
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["start"])
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels_of(base).alias("base_labels"), labels_of(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"))


def oracle_sql(templates: Sequence[Template] = TEMPLATES) -> str:
    """DuckDB SQL of ``summary(scan(documents))``."""
    rows, sizes = [], set()
    for no, t in enumerate(templates):
        w = template_words(t)
        k = min(GRAM_WORDS, len(w))
        sizes.add(k)
        rows += [f"({no}, '{t.label}', {t.base}, {len(w)}, {k}, {template_shift(len(w))}, {i}, '{' '.join(w[i:i + k])}')"
                 for i in range(len(w) - k + 1)]
    grams = " UNION ALL ".join(
        f"SELECT rid, p, {k} AS k, " + " || ' ' || ".join(f"lead(w, {j}) OVER r" if j else "w" for j in range(k)) +
        " AS gram FROM words WINDOW r AS (PARTITION BY rid ORDER BY p)" for k in sorted(sizes))
    return f"""
    WITH templates(template, label, base, size, k, shift, t, gram) AS (VALUES {', '.join(rows)}),
    docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws FROM documents),
    words AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS p FROM docs),
    grams AS ({grams}),
    hits AS (SELECT *, p - t AS diagonal FROM grams JOIN templates USING (k, gram)),
    lines AS (SELECT rid, template, label, base, size, k, shift, diagonal, list(t) AS ts, min(p) AS first, max(p) AS last
              FROM hits GROUP BY ALL HAVING count(*) >= least({MIN_VOTES}, size - k + 1)),
    marked AS (SELECT *, coalesce(diagonal - lag(diagonal) OVER w > shift, true)::INT AS new FROM lines
               WINDOW w AS (PARTITION BY rid, template ORDER BY diagonal)),
    merged AS (SELECT *, sum(new) OVER (PARTITION BY rid, template ORDER BY diagonal) AS span FROM marked),
    spans AS (SELECT rid, label, base, size, min(first) AS a, max(last) + k AS b, len(list_distinct(flatten(list_transform(
                flatten(list(ts)), lambda t: range(t, t + k))))) AS covered
              FROM merged GROUP BY rid, template, label, base, size, k, span),
    kept AS (SELECT *, covered / size::DOUBLE AS share FROM spans
             WHERE CASE WHEN base THEN covered = size
                   ELSE covered / size::DOUBLE >= {MIN_SHARE} AND covered >= {MIN_DENSITY} * (b - a) END)
    SELECT any_value(doc_id) AS doc_id, any_value(len(ws))::BIGINT AS n_words, count(*) FILTER (base) AS n_base,
           (min(a) FILTER (base))::BIGINT AS first_word, (max(a) FILTER (base))::BIGINT AS last_word,
           coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
           coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(share), 0)::DOUBLE AS score
    FROM docs LEFT JOIN kept USING (rid) GROUP BY rid"""
