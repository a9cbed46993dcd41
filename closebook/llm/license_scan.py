"""License scans with a positional index of rare licence words, by DataFrame
functions only.

Method: the document frequency of each template word is counted over all
documents. Each template gives the ``votes`` words of its mandatory phrases
that have the highest IDF to an index of postings (template, position). A file
looks up all of its words that are in the index; each place of such a word and
each posting of it give a relative position, and a template is a candidate
where all postings of it agree. A candidate is confirmed when the template's
mandatory phrases stand at their places, word for word, and at least
``min_share`` of its words do. What can be confirmed has its phrases, and so
all its postings: IDF decides what is looked up, never what is found.

Beside that stands the base: places where the words of a plain phrase stand
consecutively. Everything happens within a file's own row; the only shuffle
carries one count per index word and task. What the plan holds as literals is
the index, whose size does not depend on the data.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import lower_ascii

#: What stands between words, which are runs of a-z, 0-9 and anything beyond ASCII.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"),
        ("general public license", "gpl"))


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]  # mandatory


# Short forms and notices of public licences, as words.
TEMPLATES = (
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy "
             "of this software and associated documentation files the software to deal in the "
             "software without restriction",
             ("permission is hereby granted free of charge", "without restriction")),
    Template("apache", "licensed under the apache license version 2 0",
             ("apache license version 2 0",)),
    Template("apache", "you may not use this file except in compliance with the license you may "
             "obtain a copy of the license at", ("except in compliance with the license",)),
    Template("gpl", "this work is licensed under the gnu general public license version 3",
             ("gnu general public license",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under "
             "the terms of the gnu general public license as published by the free software "
             "foundation", ("free software", "gnu general public license")),
    Template("lgpl", "under the terms of the gnu lesser general public license",
             ("gnu lesser general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without "
             "modification are permitted provided that the following conditions are met",
             ("redistribution and use in source and binary forms",)),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license",
             ("mozilla public license",)),
    Template("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("isc", "permission to use copy modify and or distribute this software for any "
             "purpose with or without fee is hereby granted",
             ("permission to use copy modify and or distribute",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software",)),
)

SPAN = 1 << 40  # more than any position; a code is template * SPAN + relative position
SHIFT = 1 << 10  # more than any template's length, so relative positions stay positive


def words_of(text: Column) -> Column:
    """The words in order. Splitting at the gaps takes a tenth of the time of
    extracting the words; a gap at either end leaves an empty string there."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAPS), "")


def index_words(templates=TEMPLATES) -> list[str]:
    return sorted({w for t in templates for w in t.text.split()})


def document_frequencies(docs: DataFrame, templates=TEMPLATES) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those with each index word, over all of
    ``docs``. One row per index word reaches the driver."""
    index = F.array(*[F.lit(w) for w in index_words(templates)])
    found = docs.select(F.explode(F.array_append(
        F.array_intersect(index, words_of(F.col("text"))), F.lit(""))).alias("word"))
    df = {r["word"]: r["n"] for r in
          found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return df.pop("", 0), df


def _at(start: Column, length: Column) -> Column:
    """words[start : start + length]; nothing for a start before the text."""
    return F.when(start >= 0, F.slice("words", F.greatest(start, F.lit(0)) + 1, length))


def base_places(phrases=BASE) -> Column:
    """Array of (position, label number) where a phrase's words stand."""
    def hits(i: Column) -> Column:
        out = F.lit(-1)
        for n, (phrase, _) in enumerate(phrases):
            parts = phrase.split()
            match = F.lit(True)
            for k, w in reversed(list(enumerate(parts))):  # the rarer word first
                match = F.coalesce(F.get("words", i + k) == w, F.lit(False)) & match
            out = F.when(match, F.lit(n)).otherwise(out)
        return out

    places = F.transform(F.sequence(F.lit(0), F.size("words") - 1),
                         lambda i: F.struct(i.alias("at"), hits(i).alias("phrase")))
    # Each phrase ends in the same word, so at most one starts at a place.
    last = sorted({p.split()[-1] for p, _ in phrases})
    some = F.lit(False)
    for w in last:
        some = some | F.array_contains("words", w)
    none = F.array().cast("array<struct<at:int,phrase:int>>")
    return F.when(some, F.filter(places, lambda p: p["phrase"] >= 0)).otherwise(none)


def candidates(looked_up: Column, postings: Column, needs) -> tuple[Column, Column]:
    """(sorted codes, candidates): the codes (template, relative position) of all
    looked-up word places, and from column ``codes`` those on which as many of
    them agree as the template ``needs``, which are neighbours in that order."""
    places = F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    places = F.filter(places, lambda p: F.array_contains(looked_up, p["w"]))
    codes = F.array_sort(F.flatten(F.transform(places, lambda p: F.transform(
        F.element_at(postings, p["w"]), lambda c: c + p["i"]))))
    need = F.array(*map(F.lit, needs))
    agreed = F.filter("codes", lambda c, i: F.get(
        "codes", i + F.get(need, F.floor(c / SPAN).cast("int")) - 1) == c)
    return F.when(F.size(looked_up) > 0, codes), F.array_distinct(agreed)


def scan_licenses(docs: DataFrame, templates=TEMPLATES, phrases=BASE, votes: int = 2,
                  min_share: float = 0.6) -> DataFrame:
    """All columns of ``docs`` and n_words, places (array of position, label of
    each base phrase), matches (array of label, start, share of each confirmed
    template), labels (sorted, distinct, of both).

    ``votes``: the index words of a template; fewer where its phrases have
    fewer. Defined cases: a null or empty text has no words and no match; texts
    of any length are read whole; a template found twice matches twice; what a
    row matches does not depend on the other rows; an empty table gives no
    rows; input columns named as the new ones are replaced.
    """
    n, df = document_frequencies(docs, templates)
    idf = {w: math.log((n + 1) / (df.get(w, 0) + 1)) for w in index_words(templates)}
    chosen, needs = zip(*[_rarest(t, idf, votes, min_share) for t in templates])
    rare = sorted({t.text.split()[at] for t, places in zip(templates, chosen) for at in places})
    made = ("n_words", "places", "matches", "labels")
    own = [c for c in docs.columns if c not in made]
    rows = docs.select(F.struct(*own).alias("row"), words_of(F.col("text")).alias("words"))
    # A stage boundary in the plan, so that each array is computed once a row.
    rows = _once(rows, ["words"])
    looked_up = F.array_intersect(
        F.array(*[F.lit(w) for w in rare]) if rare else F.array().cast("array<string>"),
        F.col("words"))
    rows = _once(rows.select("row", "words", looked_up.alias("looked_up"),
                             base_places(phrases).alias("places")), ["looked_up", "places"])
    codes, pick = candidates(F.col("looked_up"), _postings(templates, chosen), needs)
    rows = _once(rows.withColumn("codes", codes), ["codes"])
    rows = _once(rows.withColumn("found", F.coalesce(
        pick, F.array().cast("array<bigint>"))), ["found"])
    return _confirm(rows, templates, phrases, min_share)


def _once(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Have ``columns`` computed once a row: as the output of a generator, they
    are not copied into the expressions that use them."""
    rest = [c for c in rows.columns if c not in columns]
    one = F.array(F.struct(*columns))
    return rows.select(*rest, F.explode(F.filter(one, lambda x: F.lit(True))).alias("_one")) \
        .select(*rest, *[F.col("_one")[c].alias(c) for c in columns])


def _phrase_at(words: list[str], phrase: str) -> int:
    parts = phrase.split()
    return next(i for i in range(len(words)) if words[i:i + len(parts)] == parts)


def _rarest(template: Template, idf: dict[str, float], votes: int,
            min_share: float) -> tuple[list[int], int]:
    """(positions of the rarest words, how many of them must agree). Mandatory
    phrases stand wherever the template is confirmed, so ``votes`` of their
    words do; of a template without phrases, ``min_share`` of all words stand,
    so ``votes`` of any that are more by as many as may be absent."""
    words = template.text.split()
    places = {at + k for p in template.phrases
              for at in (_phrase_at(words, p),) for k in range(len(p.split()))}
    absent = 0
    if not places:
        places = set(range(len(words)))
        absent = len(words) - max(1, sum(n / len(words) < min_share for n in range(len(words))))
    need = min(votes, len(places) - absent)
    rarest = sorted(places, key=lambda at: (-idf[words[at]], words[at], at))
    return rarest[:need + absent], need


def _postings(templates, chosen) -> Column:
    """word -> codes of its postings: template * SPAN + SHIFT - position."""
    lists: dict[str, list[int]] = {}
    for t, (template, places) in enumerate(zip(templates, chosen)):
        words = template.text.split()
        for at in places:
            lists.setdefault(words[at], []).append(t * SPAN + SHIFT - at)
    if not lists:
        lists = {"": [0]}
    return F.create_map(*[x for w, codes in sorted(lists.items()) for x in (
        F.lit(w), F.array(*[F.lit(c).cast("long") for c in codes]))])


def _confirm(rows: DataFrame, templates, phrases, min_share: float) -> DataFrame:
    forms = []
    for t in templates:
        words = t.text.split()
        need = []
        for p in t.phrases:
            parts = p.split()
            need.append(F.struct(F.lit(_phrase_at(words, p)).alias("at"),
                                 F.array(*map(F.lit, parts)).alias("parts")))
        forms.append(F.struct(F.lit(t.label).alias("label"),
                              F.array(*map(F.lit, words)).alias("parts"),
                              F.array(*need).alias("need")))
    table = F.array(*forms)

    def check(code: Column) -> Column:
        form = F.get(table, F.floor(code / SPAN).cast("int"))
        start = (code % SPAN - SHIFT).cast("int")
        whole = F.forall(form["need"], lambda p: F.coalesce(
            _at(start + p["at"], F.size(p["parts"])) == p["parts"], F.lit(False)))
        head = F.greatest(-start, F.lit(0))  # words of the template before the text
        size = F.size(form["parts"])
        there = F.slice("words", F.greatest(start, F.lit(0)) + 1, size - head)
        wanted = F.slice(form["parts"], head + 1, size)
        equal = F.size(F.filter(F.zip_with(there, wanted, lambda a, b: a == b), lambda x: x))
        return F.struct(form["label"].alias("label"), start.alias("start"),
                        F.when(whole, equal / size).otherwise(F.lit(0.0)).alias("share"))

    matches = F.filter(F.transform("found", check), lambda m: m["share"] >= min_share)
    names = F.array(*[F.lit(label) for _, label in phrases])
    places = F.transform("places", lambda p: F.struct(
        p["at"].alias("at"), F.get(names, p["phrase"]).alias("label")))
    labels = F.array_sort(F.array_distinct(F.concat(
        F.transform("places", lambda p: F.get(names, p["phrase"])),
        F.transform(matches, lambda m: m["label"]))))
    out = F.struct(F.size("words").cast("long").alias("n_words"), places.alias("places"),
                   matches.alias("matches"), labels.alias("labels"))
    return rows.select("row", out.alias("out")).select("row.*", "out.*")
