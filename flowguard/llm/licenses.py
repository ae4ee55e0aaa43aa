"""License scans by a positional rare-token index (operator 12): native DataFrame operations only.

The index has, for each template (a notice, or one of the base phrases), its words of the highest
inverse document frequency in the scanned corpus, with their positions. A file's words are looked
up in it; a posting (template, position p) at the file's word i says that the template would start
at i - p. Postings that agree on template and start are intersected, and the template's mandatory
key phrases are then compared word by word at their places.

A base phrase is its own key phrase, so each of its places has all its postings: none is missed.
Notices need half of their rare words and all of their key phrases. The frequencies come from all
documents; the driver holds templates and a count for each of their words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a template that are looked up: those of the highest IDF.
RARE = 4


@dataclass(frozen=True)
class Template:
    """A license text's opening: ``keys`` are phrases of it that must stand at their places."""

    label: str
    text: str
    keys: tuple[str, ...]
    base: bool = False


def _phrase(label: str, text: str) -> Template:
    return Template(label, text, (text,), base=True)


#: The phrases of the base labels, and the customary wording of common notices (lower case, words only).
TEMPLATES = (
    _phrase("gpl", "gnu general public license"),
    _phrase("apache", "apache license"),
    _phrase("cc-by", "cc by"),
    _phrase("mit", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
             ("permission is hereby granted free of charge", "obtaining a copy of this software")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ("permission to use copy modify and or distribute", "with or without fee")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
             ("redistribution and use in source and binary forms", "following conditions are met")),
    Template("apache", "licensed under the apache license version 2 0", ("licensed under the apache license", "version 2 0")),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
             ("you can redistribute it and or modify it", "gnu general public license")),
    Template("lgpl", "gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl", "gnu affero general public license", ("gnu affero general public license",)),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license", ("subject to the terms of the mozilla public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
    Template("cc-by-nc", "cc by nc", ("cc by nc",)),
    Template("cc-by-sa", "cc by sa", ("cc by sa",)),
    Template("cc-by", "creative commons attribution", ("creative commons attribution",)),
)


def _words(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return docs.select(F.col(doc_id).alias("doc_id"), F.regexp_extract_all(lower, F.lit(WORD), F.lit(0)).alias("words"))


def document_frequency(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, text: str = "text") -> dict[str, int]:
    """Documents that have each word of the templates: at most a row per such word reaches the driver."""
    known = sorted({w for t in templates for w in t.text.split()})
    words = _words(docs, text, text).select("words")
    seen = words.select(F.explode(F.array_distinct(F.filter("words", lambda w: w.isin(known)))).alias("w"))
    return {w: 0 for w in known} | {r["w"]: r["n"] for r in seen.groupBy("w").agg(F.count("*").alias("n")).collect()}


def rare_words(template: Template, frequency: dict[str, int], count: int = RARE) -> list[str]:
    """A template's words of the highest IDF (ties: by text)."""
    return sorted(set(template.text.split()), key=lambda w: (frequency[w], w))[:count]


def postings(templates: tuple[Template, ...], frequency: dict[str, int]) -> dict[str, list[tuple[int, int]]]:
    """Per rare word its (template, position) entries."""
    index: dict[str, list[tuple[int, int]]] = {}
    for t, template in enumerate(templates):
        rare = set(rare_words(template, frequency))
        for p, w in enumerate(template.text.split()):
            if w in rare:
                index.setdefault(w, []).append((t, p))
    return index


def _entries(index: dict[str, list[tuple[int, int]]], word: Column) -> Column:
    """A rare word's entries (template, position)."""
    array = F.array(*[F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in e]) for e in index.values()])
    return F.get(array, F.array_position(F.array(*map(F.lit, index)), word).cast("int") - 1)


def _stands(template: Template, start: Column) -> Column:
    """Every key phrase stands at its place, if the template starts at word ``start``."""
    all_words, ok = template.text.split(), F.lit(True)
    for key in template.keys:
        k = key.split()
        at = next(i for i in range(len(all_words)) if all_words[i : i + len(k)] == k)
        ok &= F.slice("words", start + 1 + at, len(k)) == F.array(*map(F.lit, k))
    return ok


def scan(docs: DataFrame, frequency: dict[str, int], templates: tuple[Template, ...] = TEMPLATES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, places, n_base, first_word, last_word, base_labels, labels, score) of every row.

    Words are runs of digits, lower-cased ASCII letters and characters beyond ASCII. places: label,
    start (word number), whether it is a base phrase, and the share of the template's rare words
    that agree, by start. n_base counts the base places, first_word and last_word are their smallest and
    largest start (null without one). score: the greatest share, 0 without a place. Null and empty
    texts have no words. Each repeated row has its own result, other columns are left out, and an
    empty table gives none. A text's words are one array in memory.
    """
    index = postings(templates, frequency)
    sizes = [sum(len([1 for x, _ in e if x == t]) for e in index.values()) for t in range(len(templates))]
    most = max(sizes)
    hits = F.filter(F.transform("words", lambda w, i: F.when(w.isin(list(index)), F.struct(i.alias("i"), w.alias("w")))), lambda h: h.isNotNull())
    starts = F.flatten(F.transform(hits, lambda h: F.transform(_entries(index, h["w"]), lambda e: F.struct(e["t"].alias("t"), (h["i"] - e["p"]).alias("s")))))
    found = _words(docs, doc_id, text).select("doc_id", "words", F.size("words").cast("long").alias("n_words"), F.array_sort(starts).alias("starts"))

    def agree(x: Column, i: Column) -> Column:  # equal entries are neighbours
        return sum(F.coalesce(F.get("starts", i + j) == x, F.lit(False)).cast("int") for j in range(most))

    met = F.filter(F.transform("starts", lambda x, i: F.when(
        (x["s"] >= 0) & ((i == 0) | (F.get("starts", i - 1) != x)), F.struct(x["t"].alias("t"), x["s"].alias("s"), agree(x, i).alias("n")))), lambda x: x.isNotNull())

    def verified(x: Column) -> Column:
        out = F.lit(False)
        for t, template in enumerate(templates):
            needed = sizes[t] if template.base else (sizes[t] + 1) // 2
            out = F.when(x["t"] == t, (x["n"] >= needed) & _stands(template, x["s"])).otherwise(out)
        return out

    label = F.array(*[F.lit(t.label) for t in templates])
    base = F.array(*[F.lit(t.base) for t in templates])
    share = F.array(*[F.lit(float(s)) for s in sizes])
    place = lambda x: F.struct(x["s"].cast("long").alias("start"), F.get(label, x["t"]).alias("label"), F.get(base, x["t"]).alias("base"),
                               (x["n"] / F.get(share, x["t"])).alias("share"))
    placed = found.select("doc_id", "words", "n_words", "starts", met.alias("met")).select(
        "doc_id", "n_words", F.array_sort(F.transform(F.filter("met", verified), place)).alias("places"))
    own = F.filter("places", lambda p: p["base"])
    names = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    return placed.select("doc_id", "n_words", "places", own.alias("own")).select(
        "doc_id", "n_words", "places", F.size("own").cast("long").alias("n_base"),
        F.array_min(F.transform("own", lambda p: p["start"])).alias("first_word"), F.array_max(F.transform("own", lambda p: p["start"])).alias("last_word"),
        names(F.col("own")).alias("base_labels"), names(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)).alias("score"))
