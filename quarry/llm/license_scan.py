"""License scans by diagonal voting.

Every template (a licence phrase or passage) is cut into rolling k-grams of words. All k-grams of all texts
are joined by hash to the templates' positions; a hit votes for its diagonal, the text's position less the
template's. Votes are summed for each text, template and diagonal. Neighbouring diagonals (words put in or
left out shift the rest by a few places) are merged to spans, and a span is laid against its template: it must
hold all k-grams of a phrase on one diagonal, or `COVER` of a passage's distinct k-grams. Where another passage
differs from a passage by words put in (a licence's name and its longer sisters), a span must also hold a k-gram
across that place, so that such words make it no other licence. Verified spans are kept, in words of the text.

The template side is fixed by `TEMPLATES`, under two thousand rows, and is broadcast; k-grams are made and
joined in the scan's tasks, so that only votes and one row for each text shuffle.

Defined cases. Null or empty text has no words, no places, empty labels and score 0. Rows are scanned one by
one, so that repeated ids stay apart and null ids are kept. Other columns are dropped.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases, found only where all their words stand consecutively; they make the base labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Passages of public licence texts, with labels of the method's own.
PASSAGES = (
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "mit"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at", "apache"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gpl"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at", "mpl"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "isc"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("licensed under cc by 4.0", "cc-by"),
    ("licensed under cc by sa 4.0", "cc-by-sa"),
    ("licensed under cc by nc 4.0", "cc-by-nc"),
    ("licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
    ("all rights reserved", "reserved"),
)
#: Words in a k-gram of a phrase and of a passage.
SHORT, LONG = 2, 3
#: Share of a passage's k-grams that a span must hold, and the shift between diagonals that are one span.
COVER, GAP = 0.75, 3


def lowered(text: Column) -> Column:
    """Lower-cases A-Z alone; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))


def slots(words: list[str], label: str, others: list[tuple[list[str], str]]) -> list[int]:
    """The places before which words put in make another licence of `words`, or made it of another."""
    found = set()
    for other, name in others:
        small, large = sorted((words, other), key=len)
        d = len(large) - len(small)
        if name == label or not d:
            continue
        for p in range(1, len(small)):
            if small[:p] == large[:p] and small[p:] == large[p + d :]:
                found |= {p} if small is words else set(range(p, p + d + 1))
    return sorted(found)


def template_grams(spark: SparkSession, phrases=PHRASES, passages=PASSAGES) -> DataFrame:
    """(gram, template, place, need, label, base, slots): a row for each k-gram of each template, some hundreds in all."""
    rows = []
    known = [(words_of(text), label) for text, label in passages]
    for base, k, texts in ((True, SHORT, phrases), (False, LONG, passages)):
        for text, label in texts:
            words = words_of(text)
            if len(words) < k:
                raise ValueError(f"a template needs {k} words: {text}")
            n, number = len(words) - k + 1, len({r[1] for r in rows})
            open_ = [] if base else slots(words, label, known)
            rows += [(words[i : i + k], number, i, n, label, base, open_) for i in range(n)]
    listed = spark.createDataFrame(rows, "words array<string>, template int, place int, need int, label string, base boolean, slots array<int>")
    hashes = F.when(F.col("base"), _gram("words", "0", SHORT)).otherwise(_gram("words", "0", LONG))
    return listed.withColumn("gram", hashes).drop("words")


def _gram(words: str, at: str, k: int) -> Column:
    return F.expr(f"xxhash64({k}, " + ", ".join(f"{words}[{at} + {j}]" for j in range(k)) + ")")


def _grams(k: int) -> str:
    inner = ", ".join(f"__words[i + {j}]" for j in range(k))
    return f"if(size(__words) >= {k}, transform(sequence(0, size(__words) - {k}), i -> struct(i as at, xxhash64({k}, {inner}) as gram)), array())"


def votes(df: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Votes for (row, template, diagonal), and for each row one without template that carries its n_words."""
    words = df.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.regexp_extract_all(lowered(F.col(text_col)), F.lit(f"({WORD})"), F.lit(1)).alias("__words"))
    own = "array(struct(-1 as at, 0L as gram))"
    found = words.select("id", "row", F.size("__words").cast("long").alias("n_words"), F.explode(F.expr(f"concat({own}, {_grams(SHORT)}, {_grams(LONG)})")).alias("g"))
    found = found.select("id", "row", "n_words", "g.at", "g.gram")
    spark = df.sparkSession
    none = spark.range(1).select(F.lit(0).cast("long").alias("gram"), *(F.lit(None).cast(templates.schema[c].dataType).alias(c) for c in templates.columns if c != "gram"))
    hits = found.join(F.broadcast(templates.unionByName(none)), "gram")
    diagonal = (F.col("at") - F.col("place")).cast("long")
    return hits.groupBy("row", "id", "n_words", "template", "label", "base", "need", diagonal.alias("diagonal")).agg(F.count("*").alias("votes"), F.collect_list(F.when(~F.col("base"), F.col("place"))).alias("places"), F.first("slots").alias("slots"))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: DataFrame | None = None) -> DataFrame:
    """A row for each row of `df`: its id, n_words, n_base, first_word, last_word, base_labels, labels, score, and spans: label, begin and end (the word after the last) of each verified span."""
    templates = template_grams(df.sparkSession) if templates is None else templates
    whole = F.col("base") & (F.col("votes") == F.col("need"))
    passage = F.when(~F.col("base"), F.struct("template", "diagonal", "places", "need", "label", "slots"))
    by_row = votes(df, templates, id_col, text_col).groupBy("row", "id", "n_words").agg(
        F.count_if(whole).alias("n_base"),
        F.min(F.when(whole, F.col("diagonal"))).alias("first_word"),
        F.max(F.when(whole, F.col("diagonal"))).alias("last_word"),
        F.collect_set(F.when(whole, F.col("label"))).alias("base_found"),
        F.collect_list(F.when(whole, F.struct("label", F.col("diagonal").alias("begin"), (F.col("diagonal") + F.col("need") + SHORT - 1).alias("end")))).alias("base_spans"),
        F.array_sort(F.collect_list(passage)).alias("marks"),
    )
    # One walk over the sorted diagonals of all passages: neighbours' places are united; `found` keeps verified spans, the last one is added when the walk ends.
    verified = f"size(s.places) >= {COVER} * s.need and forall(s.slots, p -> exists(s.places, x -> x between p - {LONG - 1} and p - 1))"
    closed = f"if(s.template >= 0 and {verified}, concat(s.found, array(struct(s.label as label, s.begin as begin, s.end as end))), s.found)"
    near = f"(s.template = m.template and m.diagonal - s.diagonal <= {GAP})"
    walk = f"""aggregate(marks,
        struct(-1 as template, 0L as diagonal, cast(array() as array<int>) as places, 0 as need, '' as label, cast(array() as array<int>) as slots,
               0L as begin, 0L as end, 0D as best, cast(array() as array<struct<label:string,begin:bigint,end:bigint>>) as found),
        (s, m) -> transform(array(if({near}, array_union(s.places, m.places), m.places)), v ->
            struct(m.template as template, m.diagonal as diagonal, v as places, m.need as need, m.label as label, m.slots as slots,
                   if({near}, least(s.begin, m.diagonal + array_min(m.places)), m.diagonal + array_min(m.places)) as begin,
                   if({near}, greatest(s.end, m.diagonal + array_max(m.places) + {LONG}), m.diagonal + array_max(m.places) + {LONG}) as end,
                   greatest(s.best, least(1D, size(v) / m.need)) as best, if({near}, s.found, {closed}) as found))[0],
        s -> struct(s.best as best, {closed} as found))"""
    walked = by_row.withColumn("walk", F.expr(walk))
    return walked.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base_found"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_found", F.col("walk.found.label"))), ",").alias("labels"),
        F.greatest(F.when(F.col("n_base") > 0, 1.0).otherwise(0.0), F.col("walk.best")).alias("score"),
        F.array_sort(F.concat("base_spans", "walk.found")).alias("spans"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir).select("doc_id", "text"))


QUERIES = {"op9_license_scan": op9_license_scan}
SQL: dict[str, str] = {}
