"""License scans with a positional index of rare words, in column functions only.

A template is a run of words with a label, and some of its phrases are mandatory. Of each template the ``rare`` words of highest inverse document
frequency, counted over all documents scanned (fewest documents first, ties by the word), are indexed: a posting is a word, a template and the
word's place in it. A file's words that are in the index are its rarest licence words; each of them looks up its postings, and a posting
says where the template would have to begin. Postings that agree on template and beginning are intersected: where at least half of
a template's postings agree, the template is a candidate, and it is found if every mandatory phrase stands at its relative place. A
template that is one mandatory phrase needs no more than its rarest word, so each place of such a phrase is found.

ASCII capitals count as small letters; a word is a run of ASCII letters and digits and of all characters beyond ASCII. The score of a file is the
largest share, over the templates found in it, of template words that stand at their relative place, and 0 without one.

Everything about a file happens in its row: nothing is shuffled but the document counts of the template words, and only these, a number for each
word of the templates, come to the driver. Work and memory grow with a file's words and its indexed words, which are sorted.

A null text has no words. Every row gives a row, repeated ones too. Columns other than those asked for are not read. No rows give no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: All other ASCII characters.
BETWEEN = "".join(c for c in map(chr, range(128)) if not c.isalnum())
#: Words of a template that are indexed.
RARE = 4


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    mandatory: tuple[str, ...]  # phrases of the text; all of it if there are none
    base: bool = False

    @property
    def words(self) -> list[str]:
        return re.findall(WORD, self.text)

    @property
    def required(self) -> list[int]:
        """Places of the words that have to be there."""
        words = self.words
        if not self.mandatory:
            return list(range(len(words)))
        places = set()
        for phrase in self.mandatory:
            part = re.findall(WORD, phrase)
            starts = [i for i in range(len(words)) if words[i : i + len(part)] == part]
            if not starts:
                raise ValueError(f"{phrase!r} is no phrase of the template {self.label}")
            places |= set(range(starts[0], starts[0] + len(part)))
        return sorted(places)


#: Three phrases as they are agreed on, and opening or characteristic words of common licences and notices.
TEMPLATES = (
    Template("mit", "under the mit license", (), base=True),
    Template("apache-2", "apache license version 2", (), base=True),
    Template("cc-by-nc", "cc by nc", (), base=True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the "
             "software to deal in the software without restriction", ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
             ("apache license version 2 0", "except in compliance with the license")),
    Template("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published "
             "by the free software foundation either version 2 of the license", ("the gnu general public license", "version 2 of the license")),
    Template("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published "
             "by the free software foundation either version 3 of the license", ("the gnu general public license", "version 3 of the license")),
    Template("gpl-2", "gnu general public license version 2", ()),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("lgpl", "gnu lesser general public license", ()),
    Template("agpl-3", "gnu affero general public license", ()),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
             ("redistribution and use in source and binary forms", "following conditions are met")),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ("permission to use copy modify and or distribute", "with or without fee is hereby granted")),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software released into the public domain",)),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
    Template("cc0", "has waived all copyright and related or neighboring rights to", ("waived all copyright and related",)),
)


def words_of(text: Column) -> Column:
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), CAPITALS + BETWEEN, SMALL + " " * len(BETWEEN))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def _known(words: Column, vocabulary: list[str]) -> Column:
    return words.isin(*vocabulary) if vocabulary else F.lit(False)


def document_counts(docs: DataFrame, vocabulary: list[str], text: str = "text") -> dict[str, int]:
    """In how many rows each word of the vocabulary occurs: as many rows for the driver as the vocabulary has words."""
    found = docs.select(F.explode(F.array_distinct(F.filter(words_of(F.col(text)), lambda w: _known(w, vocabulary)))).alias("word"))
    return {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}


def rare_index(templates: tuple[Template, ...], counts: dict[str, int], rare: int = RARE) -> list[dict[str, list[int]]]:
    """For each template its indexed words with their places in it."""
    out = []
    for t in templates:
        words = t.words
        whole = len(t.required) == len(words)
        chosen = sorted(set(words), key=lambda w: (counts.get(w, 0), w))[: 1 if whole else rare]
        # of a template that is one phrase a single posting is enough
        out.append({w: [i for i, x in enumerate(words) if x == w][: 1 if whole else None] for w in chosen})
    return out


def needed(index: dict[str, list[int]]) -> int:
    """How many postings of a template have to agree."""
    return (sum(map(len, index.values())) + 1) // 2


def scan(docs: DataFrame, keep: list[str], templates: tuple[Template, ...] = TEMPLATES, rare: int = RARE, text: str = "text") -> DataFrame:
    """The columns of ``keep``, n_words, and ``places``, an array of (template, label, base, start, score) in order of template and start."""
    vocabulary = sorted({w for t in templates for w in t.words})
    index = rare_index(templates, document_counts(docs, vocabulary, text), rare)
    indexed = sorted({w for own in index for w in own})
    postings = [F.array(*[F.struct(F.lit(t).alias("t"), F.lit(i).alias("i")) for t, own in enumerate(index) for i in own.get(w, [])]) for w in indexed]
    lookup = F.create_map(*[x for w, p in zip(indexed, postings, strict=True) for x in (F.lit(w), p)])

    def word(i: int, w: str) -> Column:
        return F.struct(F.lit(i).alias("i"), F.lit(w).alias("w"))

    known = F.array(
        *[
            F.struct(
                F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), F.lit(needed(own)).alias("need"),
                F.array(*[word(i, w) for i, w in enumerate(t.words)]).alias("words"), F.array(*[word(i, t.words[i]) for i in t.required]).alias("required"),
            )
            for t, own in zip(templates, index, strict=True)
        ]
    )
    rows = docs.select(*keep, words_of(F.col(text)).alias("_words"))
    words = F.col("_words")
    hits = F.array_compact(F.transform(words, lambda w, i: F.when(_known(w, indexed), F.struct(i.alias("at"), w.alias("w")))))
    rows = rows.select(*keep, "_words", F.size(words).cast("bigint").alias("n_words"), hits.alias("_hits"))

    def looked_up(h: Column) -> Column:
        return F.transform(F.element_at(lookup, h["w"]), lambda p: F.struct(p["t"].alias("t"), (h["at"] - p["i"]).alias("start")))

    agreeing = F.sort_array(F.flatten(F.transform("_hits", looked_up)))
    rows = rows.select(*keep, "_words", "n_words", agreeing.alias("_found"))

    # the first of each run of equal (t, start), then the run's length
    def first(f: Column, i: Column) -> Column:
        return F.when((i == 0) | (F.get(F.col("_found"), i - 1) != f), i)

    rows = rows.select(*keep, "_words", "n_words", "_found", F.array_compact(F.transform("_found", first)).alias("_heads"))

    def counted(head: Column, j: Column) -> Column:
        f = F.get(F.col("_found"), head)
        votes = F.coalesce(F.get(F.col("_heads"), j + 1), F.size("_found")) - head
        return F.struct(f["t"].alias("t"), f["start"].alias("start"), votes.alias("votes"), F.get(known, f["t"]).alias("of"))

    candidates = F.filter(F.transform("_heads", counted), lambda c: c["votes"] >= c["of"]["need"])

    def stands(c: Column):
        return lambda x: F.get(words, c["start"] + x["i"]).eqNullSafe(x["w"])  # null outside of the file

    verified = F.filter(candidates, lambda c: F.forall(c["of"]["required"], stands(c)))
    places = F.transform(
        verified,
        lambda c: F.struct(
            c["t"].alias("template"), c["of"]["label"].alias("label"), c["of"]["base"].alias("base"), c["start"].alias("start"),
            (F.size(F.filter(c["of"]["words"], stands(c))) / F.size(c["of"]["words"])).alias("score"),
        ),
    )
    return rows.select(*keep, "n_words", places.alias("places"))


def labels_of(places: Column) -> Column:
    """Distinct labels in order, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
