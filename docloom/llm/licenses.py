"""Licence notices in texts by a positional index of the rarest licence words."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, table

NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Fixed: the phrases that are always looked for, and their labels.
BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
#: Fixed: label, notice as it is usually given, and the phrases of it that must stand word for word.
NOTICES = [
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ["gnu general public license as published", "either version 3 of the license"]),
    ("gpl-2.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", ["gnu general public license as published", "either version 2 of the license"]),
    ("lgpl", "under the gnu lesser general public license version", ["gnu lesser general public license"]),
    ("agpl", "under the gnu affero general public license version", ["gnu affero general public license"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ["hereby granted free of charge", "deal in the software without restriction"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["use copy modify and or distribute this software", "with or without fee is hereby granted"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc-by-4.0", "under creative commons attribution 4 0 international license", ["creative commons attribution 4 0"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["source and binary forms"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software"]),
]
#: Words of the first key phrase, rarest first, whose places are met; rarest words beside it that make up a notice's score.
N_RARE, N_SCORED = 2, 8
#: So many words may be put in or left out between a notice's first key phrase and its other parts.
SLACK = 6


class Template:
    """A notice as words with their distance from its first key phrase, which must stand whole, as must the other ones."""

    def __init__(self, label: str, notice: str, phrases: list[str]):
        words = notice.split()
        at = [next((i for i in range(len(words)) if words[i : i + len(p.split())] == p.split()), None) for p in phrases]
        if not phrases or None in at:
            raise ValueError(f"{label}: a key phrase is not in the notice")
        self.label, self.phrase = label, phrases[0].split()
        self.others = [(i - at[0], p.split()) for i, p in zip(at[1:], phrases[1:])]
        self.words = [(i - at[0], w) for i, w in enumerate(words)]

    def scored(self, idf: dict[str, float]) -> list[tuple[int, str]]:
        """The words of the first key phrase and the N_SCORED rarest others, with their distance from it."""
        others = [(d, w) for d, w in self.words if not 0 <= d < len(self.phrase)]
        return [*enumerate(self.phrase), *sorted(others, key=lambda x: (-idf[x[1]], x[0]))[:N_SCORED]]


def templates(given: DataFrame | None = None) -> list[Template]:
    """The base phrases, and the notices given (label, text, phrases; NOTICES by default). Notices are few: all are held in the plan.

    A given notice and its phrases are read as words like any text.
    """
    notices = NOTICES
    if given is not None:
        as_words = lambda t: F.array_join(words_of(t), " ")
        notices = [tuple(r) for r in given.select("label", as_words(F.col("text")), F.transform("phrases", as_words)).collect()]
    return [Template(label, phrase, [phrase]) for phrase, label in BASE] + [Template(*n) for n in notices]


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def rarity(rows: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency of each licence word over all rows (column words); as many numbers as there are licence words."""
    seen = rows.select(F.explode(F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary)))).alias("w")).groupBy("w").count()
    counts, n = {r["w"]: r["count"] for r in seen.collect()}, rows.count()
    return {w: math.log((n + 1) / (counts.get(w, 0) + 0.5)) for w in vocabulary}


def matches(all_of: list[Template], idf: dict[str, float]) -> Column:
    """Array of (t, at, score) over the columns words and hits: template, word number of its first key phrase, share of its
    rarest words found where they belong, by rarity.

    hits are a file's licence words that some postings list has, with their places. A hit of a phrase's rarest word
    proposes the phrase's start, by the postings of that word alone; the start stays if the next rarest word stands at its
    own distance, and then all key phrases are verified, the first at the start, the others within SLACK words.
    """
    leads = [sorted(range(len(x.phrase)), key=lambda q, x=x: (-idf[x.phrase[q]], q))[:N_RARE] for x in all_of]
    postings: dict[str, list[Column]] = {}
    for t, (x, lead) in enumerate(zip(all_of, leads)):
        entry = F.struct(F.lit(t).alias("t"), F.lit(lead[0]).alias("p"), F.lit(lead[-1]).alias("q"), F.lit(x.phrase[lead[-1]]).alias("next"))
        postings.setdefault(x.phrase[lead[0]], []).append(entry)
    by_word = F.create_map(*(c for w, entries in postings.items() for c in (F.lit(w), F.array(*entries))))
    texts = lambda parts, kind: F.array(*(F.lit(w) for w in parts)) if parts else F.array().cast(kind)
    phrases = F.array(*(texts(x.phrase, "array<string>") for x in all_of))
    other = F.struct(F.lit(0).alias("at"), F.array(F.lit("")).alias("words"))
    others = F.array(*(F.array(*(F.struct(F.lit(d).alias("at"), texts(p, "array<string>").alias("words")) for d, p in x.others)) if x.others else F.slice(F.array(other), 2, 1) for x in all_of))
    scored = [x.scored(idf) for x in all_of]
    wanted = F.array(*(F.array(*(F.struct(F.lit(d).alias("at"), F.lit(w).alias("w"), F.lit(idf[w]).alias("idf")) for d, w in own)) for own in scored))
    word = lambda i: F.get(F.col("words"), i)
    slack = F.sequence(F.lit(-SLACK), F.lit(SLACK))

    def stands(phrase: Column, at: Column) -> Column:
        return F.forall(F.transform(phrase, lambda w, q: F.coalesce(word(at + q) == w, F.lit(False))), lambda x: x)

    def proposals(h: Column) -> Column:
        met = F.filter(F.try_element_at(by_word, h["w"]), lambda p: F.coalesce(word(h["i"] - p["p"] + p["q"]) == p["next"], F.lit(False)))
        return F.transform(met, lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["p"]).alias("at")))

    found = F.filter(F.flatten(F.transform("hits", proposals)), lambda c: (c["at"] >= 0) & stands(F.get(phrases, c["t"]), c["at"]))
    whole = F.filter(found, lambda c: F.forall(F.get(others, c["t"]), lambda o: F.exists(slack, lambda d: stands(o["words"], c["at"] + o["at"] + d))))

    def score(c: Column) -> Column:
        own = F.get(wanted, c["t"])
        total = lambda words: F.aggregate(words, F.lit(0.0), lambda a, x: a + x["idf"])
        here = F.filter(own, lambda x: F.exists(slack, lambda d: F.coalesce(word(c["at"] + x["at"] + d) == x["w"], F.lit(False))))
        return F.struct(c["t"].alias("t"), c["at"].alias("at"), (total(here) / total(own)).alias("score"))

    return F.transform(whole, score)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: DataFrame | None = None) -> DataFrame:
    """Licence labels of every row.

    notices: label, text and key phrases of the notices to look for, besides the base phrases; a phrase must be in its text
    (ValueError). Returns doc_id, n_words, n_base (places of base phrases), first_word and last_word (their least and
    greatest start, in words from 0; null without any), base_labels, labels (those of the notices too; both distinct,
    sorted, joined by commas, empty without any), score (best share of a found notice's rarest words, weighted by rarity; 0
    without any). Null and empty texts have no words. Repeated rows are all returned; an empty table gives no rows; other
    columns are left out.
    """
    all_of = templates(notices)
    rows = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    idf = rarity(rows, sorted({w for x in all_of for _, w in x.words}))
    looked_up = sorted({max(x.phrase, key=lambda w: (idf[w], -x.phrase.index(w))) for x in all_of})
    hits = F.filter(F.transform("words", lambda w, i: F.when(w.isin(looked_up), F.struct(w.alias("w"), i.alias("i")))), lambda x: x.isNotNull())
    rows = rows.withColumn("hits", hits)
    none = F.array().cast("array<struct<t:int,at:int,score:double>>")
    rows = rows.withColumn("_m", F.when(F.size("hits") > 0, matches(all_of, idf)).otherwise(none))
    base = F.filter("_m", lambda m: m["t"] < len(BASE))
    label = F.array(*(F.lit(x.label) for x in all_of))
    names = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: F.get(label, m["t"])))), ",")
    starts = F.transform(base, lambda m: m["at"].cast("long"))
    return rows.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("_m")).alias("labels"), F.coalesce(F.array_max(F.transform("_m", lambda m: F.least(m["score"], F.lit(1.0)))), F.lit(0.0)).alias("score"),
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
