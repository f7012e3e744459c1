"""Licence scanning over a positional index of rare words. DataFrame operations only.

Document frequencies over the whole corpus, found in a first pass, give each word of the templates its IDF. A template's rare
words are those of highest IDF without which less than ``FLOOR`` of its IDF would be left; they are indexed as postings
(word, template, offset). The second pass looks up the rare words that each file holds, by which its postings propose
alignments (template, start); equal ones are intersected to one, and the template's other words then have to stand at their
places relative to that start. An alignment that matches ``FLOOR`` of a template's IDF holds a rare word at its place, so that
none of those is missed. A template is found where all words of its mandatory phrase stand and the IDF that is matched is at
least ``COVER`` of the template's. The second pass shuffles nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import read_table

#: Shares of a template's IDF: matched by a found one at least, and by an alignment that counts for the score at least.
COVER, FLOOR = 0.8, 0.5


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str = ""  #: the phrase that must stand complete; the whole text if empty
    base: bool = False


# Phrases and their labels.
BASE = (
    Template("cc-by", "cc by", base=True),
    Template("gpl", "general public license", base=True),
    Template("reserved", "all rights reserved", base=True),
)
# Passages of well-known licences, as words in lower case.
OWN = (
    Template("agpl", "affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at", "you may not use this file except in compliance with the license"),
    Template("artistic-2.0", "the artistic license 2 0", "artistic license 2 0"),
    Template("boost", "boost software license version 1 0", "boost software license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    Template("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "must retain the above copyright notice"),
    Template("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "may be used to endorse or promote products derived from this software"),
    Template("cc0", "cc0 1 0 universal", "cc0"),
    Template("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0 international"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike 4 0 international"),
    Template("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", "eclipse public license 2 0"),
    Template("eupl", "european union public licence"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "under the terms of the gnu general public license"),
    Template("gpl-2.0", "gnu general public license version 2"),
    Template("gpl-3.0", "gnu general public license version 3"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "with or without fee is hereby granted"),
    Template("lgpl", "lesser general public license"),
    Template("mit", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "permission is hereby granted free of charge"),
    Template("mpl-2.0", "mozilla public license version 2 0", "mozilla public license"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "subject to the terms of the mozilla public license"),
    Template("ofl-1.1", "this font software is licensed under the sil open font license version 1 1", "sil open font license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    Template("warranty", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", "provided as is without warranty of any kind"),
    Template("wtfpl", "do what the fuck you want to public license"),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", "without any express or implied warranty"),
)

#: A word once A-Z are lower case. The Kelvin sign is the one other character whose lower case is a single ASCII letter.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KELVIN, _OTHER = "\u212a", "\u00b5"


def _words(text: Column) -> Column:
    low = F.lower(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit(_KELVIN), F.lit(_OTHER)))
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def _let(value: Column, f) -> Column:
    """f of ``value``, which is made once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def weights(docs: DataFrame, vocabulary: list[str], text_col: str) -> dict[str, float]:
    """The IDF of each word of the vocabulary over all documents; one row a word comes to the driver."""
    known = F.array(*map(F.lit, vocabulary))
    seen = docs.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(known, _words(F.col(text_col))))).alias("word"))  # "" for the document itself
    df = {r["word"]: r["n"] for r in seen.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return {w: math.log((df.get("", 0) + 1) / (df.get(w, 0) + 0.5)) for w in vocabulary}


def rare_words(words: list[str], idf: dict[str, float]) -> set[str]:
    """The words of highest IDF without which the others have less than FLOOR of the template's IDF, ties by the word."""
    left, out = sum(idf[w] for w in words), set()
    least = FLOOR * left
    for w in sorted(set(words), key=lambda w: (-idf[w], w)):
        if left < least - 1e-9:
            break
        out.add(w)
        left -= idf[w] * words.count(w)
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", own: tuple[Template, ...] = OWN) -> DataFrame:
    """One row a row: (id_col, n_words, n_base, first_word, last_word, base_labels, labels, score).

    ``n_base`` counts all places of the base phrases, ``first_word`` and ``last_word`` are the smallest and largest word
    number at which one starts (null without any). Labels are distinct, sorted and joined by commas, empty without any.
    ``score`` is the largest share of a template's IDF that an alignment matches: 1 for a complete one, 0 where none has
    ``FLOOR``. Null counts as empty, repeated rows and rows without id get a row each, and texts of any length are read whole;
    an empty table gives no rows. Other columns are not read.
    """
    templates = [*BASE, *own]
    split = [(t.text.split(), (t.key or t.text).split()) for t in templates]
    vocabulary = sorted({w for text, _ in split for w in text})
    idf = weights(docs, vocabulary, text_col)
    table, postings = [], {}
    for i, (t, (text, key)) in enumerate(zip(templates, split, strict=True)):
        at = next(a for a in range(len(text)) if text[a : a + len(key)] == key)
        table.append(F.struct(
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), F.array(*map(F.lit, text)).alias("words"), F.array(*(F.lit(idf[w]) for w in text)).alias("idf"),
            F.lit(float(sum(idf[w] for w in text))).alias("whole"), F.lit(at).alias("must_from"), F.lit(at + len(key)).alias("must_to"),
        ))
        for w in rare_words(text, idf):
            postings.setdefault(w, []).extend((i, o) for o, x in enumerate(text) if x == w)
    table = F.array(*table)
    rare = sorted(postings)
    index = F.array(*(F.array(*(F.struct(F.lit(t).alias("t"), F.lit(o).alias("o")) for t, o in postings[w])) for w in rare))
    rare_ = F.array(*map(F.lit, rare))

    def alignments(words: Column) -> Column:
        """Distinct (t, start) that the file's rare words propose."""
        placed = F.transform(words, lambda w, i: F.struct(F.array_position(rare_, w).cast("int").alias("at"), i.alias("pos")))
        hits = F.filter(placed, lambda h: h["at"] > 0)
        each = F.transform(hits, lambda h: F.transform(F.element_at(index, h["at"]), lambda p: F.struct(p["t"].alias("t"), (h["pos"] - p["o"]).alias("start"))))
        return F.array_distinct(F.flatten(each))

    def filled(words: Column, a: Column) -> Column:
        """What of its template an alignment matches."""

        def of(t: Column) -> Column:
            stands = F.transform(t["words"], lambda w, j: F.coalesce(F.get(words, a["start"] + j) == w, F.lit(False)))
            weigh = F.aggregate(F.zip_with(stands, t["idf"], lambda s, x: F.when(s, x).otherwise(0.0)), F.lit(0.0), lambda x, y: x + y)
            must = F.slice(stands, t["must_from"] + 1, t["must_to"] - t["must_from"])
            share = F.when(F.forall(stands, lambda s: s), 1.0).otherwise(F.when(t["whole"] > 0, F.least(weigh / t["whole"], F.lit(1.0))).otherwise(0.0))
            found = F.forall(must, lambda s: s) & (share >= COVER)
            return F.struct(t["label"].alias("label"), (t["base"] & found).alias("base"), found.alias("found"), a["start"].cast("long").alias("start"), share.alias("share"))

        return _let(F.element_at(table, a["t"] + 1), of)

    none = F.array().cast("array<struct<label:string,base:boolean,found:boolean,start:bigint,share:double>>")
    result = lambda words: F.when(F.arrays_overlap(rare_, words), F.transform(alignments(words), lambda a: filled(words, a))).otherwise(none)
    parts = lambda words: F.struct(F.size(words).cast("long").alias("n"), result(words).alias("a"))
    rows = docs.select(F.col(id_col).alias(id_col), _let(_words(F.col(text_col)), parts).alias("x"))

    def summary(x: Column) -> Column:
        def of(base: Column) -> Column:
            labels = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda y: y["label"]))), ",")
            starts, shares = F.transform(base, lambda b: b["start"]), F.filter(F.transform(x["a"], lambda b: b["share"]), lambda s: s >= FLOOR)
            return F.struct(
                x["n"].alias("n_words"), F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                labels(base).alias("base_labels"), labels(F.filter(x["a"], lambda b: b["found"])).alias("labels"), F.round(F.coalesce(F.array_max(shares), F.lit(0.0)), 9).alias("score"),
            )

        return _let(F.filter(x["a"], lambda b: b["base"]), of)

    return rows.select(id_col, _let(F.col("x"), summary).alias("s")).select(id_col, "s.*")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))
