"""Licence notices in files by a positional index of rare words.

The index holds, for every licence template, its ``RARE`` words of highest
inverse document frequency with their positions.  The frequencies are those of
the given documents, all of them.  A file looks its indexed words up, each
posting (template, position) gives the place where the template would begin,
and postings of one template that agree on the place, within ``SLACK`` words,
are intersected: where ``SHARE`` of the template's rare words meet, the
template's mandatory key phrases must stand word for word near their position.
Phrases (short names of licences) are looked up by their one rarest word and
verified word for word; every place counts.

Only DataFrame functions are used and no row leaves its partition: the first
pass splits every text once and keeps where words of the templates and phrases
stand, as a written table; of it one row per such word, with its number of
documents, reaches the driver, and the second pass evaluates every file from its
kept words.  A file's work is linear in its words and sorts its postings.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of characters
beyond ASCII.  Defined cases: null text is empty; a file without words has no
label, score 0 and null first and last word; words of equal frequency are taken
in their order; repeated rows count as rows; an empty table gives no row; other
columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# Names of licences that are found as they stand, by label.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Public licence notices (label, text, mandatory key phrases).
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
     ("permission is hereby granted free of charge", "without restriction")),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
            "list of conditions and the following disclaimer",
     ("redistribution and use in source and binary forms", "conditions are met")),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
               "with the License. You may obtain a copy of the License at",
     ("you may not use this file except in compliance with the license",)),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version",
     ("gnu general public license", "free software foundation")),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
             "your option) any later version",
     ("gnu lesser general public license", "free software foundation")),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
            "not distributed with this file, You can obtain one at",
     ("mozilla public license",)),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies",
     ("for any purpose with or without fee is hereby granted",)),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software",
     ("free and unencumbered software", "public domain")),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
     ("creative commons attribution 4 0",)),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    ("reserved", "All rights reserved", ("all rights reserved",)),
)
RARE = 8      # indexed words of a template
SHARE = 0.75  # of these that must agree on the place
SLACK = 8     # words by which places may differ

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text: str) -> list[str]:
    """The words of a template or phrase (ASCII)."""
    return re.findall(WORD, text.lower())


def words_of(text: Column) -> Column:
    # of the characters beyond ASCII only the Kelvin sign has an ASCII lower case; it stays one beyond ASCII
    return F.regexp_extract_all(F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ"))),
                                F.lit(WORD), F.lit(0))


def known_words(docs: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """doc_id, n_words and ``hits``: array of (w, i), the words of the vocabulary
    in a text with their positions, in order."""
    rows = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    numbered = F.transform("words", lambda w, i: F.when(w.isin(*vocabulary), F.struct(w.alias("w"), i.cast("long").alias("i"))))
    return rows.select("doc_id", F.size("words").cast("long").alias("n_words"), F.array_compact(numbered).alias("hits"))


def document_frequencies(known: DataFrame) -> dict[str, int]:
    """In how many documents each word of ``known_words`` occurs."""
    rows = known.select(F.explode(F.array_distinct("hits.w")).alias("word")).groupBy("word").count()
    return {r["word"]: r["count"] for r in rows.collect()}  # one row per word of the vocabulary at most


def rarest(words: Sequence[str], seen: Mapping[str, int], most: int) -> list[str]:
    """The ``most`` distinct words of highest inverse document frequency."""
    return sorted(set(words), key=lambda w: (seen.get(w, 0), w))[:most]


def _array(items: Sequence[str], kind: str) -> str:
    return f"cast(array({', '.join(items)}) as array<{kind}>)"


def _words_sql(words: Sequence[str]) -> str:
    return _array([f"'{w}'" for w in words], "string")  # letters and digits only


def _postings(entries: Sequence[tuple[str, str]], kind: str) -> str:
    """SQL for the postings of the word ``h.w``; ``entries``: word and posting, as SQL."""
    lists: dict[str, list[str]] = {}
    for word, posting in entries:
        lists.setdefault(word, []).append(posting)
    pairs = ", ".join(f"'{w}', array({', '.join(p)})" for w, p in sorted(lists.items()))
    lookup = f"try_element_at(map({pairs}), h.w), " if pairs else ""
    return f"coalesce({lookup}cast(array() as array<{kind}>))"


def _position(text: Sequence[str], phrase: Sequence[str]) -> int:
    places = [i for i in range(len(text)) if list(text[i:i + len(phrase)]) == list(phrase)]
    if not places:
        raise ValueError(f"key phrase {' '.join(phrase)!r} does not stand in its template")
    return places[0]


def scan(docs: DataFrame, templates: Sequence[tuple[str, str, tuple[str, ...]]] = TEMPLATES,
         phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """doc_id, n_words, ``places`` (array of (start, label) of phrases, by start),
    ``notices`` (array of (label, start, share): templates found, the window of
    2 * SLACK words in which they begin, and the share of their rare words that
    agree on it; neighbouring windows overlap) and ``score``: 1 with a phrase,
    else the best share, 0 with neither."""
    texts = [(label, plain_words(text), [plain_words(k) for k in keys]) for label, text, keys in templates]
    names = [(plain_words(p), label) for p, label in phrases.items()]
    vocabulary = sorted({w for _, t, _ in texts for w in t} | {w for p, _ in names for w in p})
    known = written(known_words(docs, vocabulary), "known-words")
    seen = document_frequencies(known)
    rare = [rarest(t, seen, RARE) for _, t, _ in texts]
    by_word = [(w, f"named_struct('t', {t}L, 'no', {rare[t].index(w)}L, 'at', {i}L)")
               for t, (_, text, _) in enumerate(texts) for i, w in enumerate(text) if w in rare[t]]
    keys = sorted({(t, _position(text, k), tuple(k)) for t, (_, text, ks) in enumerate(texts) for k in ks})
    by_name = []
    # phrases are numbered from 0, key phrases after them
    for no, words in enumerate([words for words, _ in names] + [list(k) for _, _, k in keys]):
        i = words.index(rarest(words, seen, 1)[0])
        by_name.append((words[i], f"named_struct('no', {no}, 'at', {i}, 'words', {_words_sql(words)})"))
    indexed = sorted({w for w, _ in by_word + by_name})

    window = 2 * SLACK
    ahead = window * (1 + max((len(t) for _, t, _ in texts), default=0))  # keeps places positive
    needs = _array([f"{math.ceil(SHARE * len(r))}" for r in rare], "int")
    sizes = _array([f"{len(r)}D" for r in rare], "double")
    labels = _array([f"'{label}'" for label, _, _ in texts], "string")
    phrase_labels = _array([f"'{label}'" for _, label in names], "string")
    key_of = _array([_array([f"named_struct('no', {len(names) + no}, 'at', {at}L)" for no, (u, at, _) in enumerate(keys) if u == t],
                            "struct<no:int,at:bigint>") for t in range(len(texts))], "array<struct<no:int,at:bigint>>")
    # a code holds template and grid (2^35), window (64) and word; windows of the second grid begin SLACK words earlier
    grids = ", ".join(f"(((p.t * 2 + {g}) * {1 << 34}L + (h.i - p.at + {ahead + g * SLACK}L) div {window}) * 64 + p.no)" for g in (0, 1))

    def step(df: DataFrame, name: str, sql: str) -> DataFrame:
        return df.withColumn(name, F.expr(sql))

    # a hit's number among the hits goes with it: a phrase's words are all kept, so that they follow one another there too
    rows = known.withColumn("indexed", F.filter(
        F.transform("hits", lambda h, j: F.struct(h["w"].alias("w"), h["i"].alias("i"), j.alias("j"))),
        lambda h: h["w"].isin(*indexed)))
    rows = step(rows, "stand", f"""
        flatten(transform(indexed, h -> transform(filter({_postings(by_name, "struct<no:int,at:int,words:array<string>>")},
            p -> h.j >= p.at and slice(hits.w, greatest(h.j - p.at, 0) + 1, size(p.words)) = p.words
                 and get(hits, h.j - p.at).i = h.i - p.at
                 and get(hits, h.j - p.at + size(p.words) - 1).i = h.i - p.at + size(p.words) - 1),
            p -> named_struct('start', h.i - p.at, 'no', p.no))))""")
    rows = step(rows, "places", f"""
        array_sort(transform(filter(stand, x -> x.no < {len(names)}),
            x -> named_struct('start', x.start, 'label', get({phrase_labels}, x.no))))""")
    rows = step(rows, "codes", f"""
        array_sort(array_distinct(flatten(transform(indexed, h -> flatten(transform(
            {_postings(by_word, "struct<t:bigint,no:bigint,at:bigint>")}, p -> array({grids})))))))""")
    # codes are distinct and sorted: a window holds m words if the code m - 1 places on is of the same window
    rows = step(rows, "windows", f"""
        array_distinct(transform(filter(codes, (k, j) -> get(codes, j + get({needs}, cast(k div {1 << 41}L as int)) - 1) div 64 = k div 64),
            k -> k div 64))""")
    rows = step(rows, "notices", f"""
        transform(windows, c -> named_struct('t', cast(c div {1 << 35}L as int),
            'start', (c % {1 << 34}L) * {window} - {ahead}L - ((c div {1 << 34}L) % 2) * {SLACK},
            'found', size(filter(codes, k -> k div 64 = c))))""")
    rows = step(rows, "notices", f"""
        transform(filter(notices, n -> forall(get({key_of}, n.t), k -> exists(stand,
            x -> x.no = k.no and x.start between n.start + k.at - {SLACK} and n.start + k.at + {window + SLACK}))),
            n -> named_struct('label', get({labels}, n.t), 'start', greatest(n.start, 0L), 'share', n.found / get({sizes}, n.t)))""")
    return rows.select("doc_id", "n_words", "places", "notices",
                       F.when(F.size("places") > 0, 1.0).otherwise(
                           F.coalesce(F.array_max(F.transform("notices", lambda n: n["share"])), F.lit(0.0))).alias("score"))
