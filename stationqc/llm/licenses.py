"""Licence scan by a positional index of rare template words (native Spark only).

Templates are word sequences with a label, a number of words that must agree and
mandatory key phrases.  Words are weighted by their inverse document frequency over
all documents, and a template is indexed under the positions of its rarest words: as
many as may disagree and one more, so a text that agrees enough cannot avoid them all.
Each document looks up those words where it holds them; a posting (template, position)
proposes the place word index - position, and a place is kept when enough words agree
at their relative positions, among them every word of the key phrases.  A place that
several postings propose counts under the rarest that agrees.

Everything per document happens within its row, on the array of its words: no rows
are exploded or shuffled but the document counts of the template words.

Defined results: null text is empty and has no words; a text without places has empty
labels, null first and last words and score 0; rows are independent, so repeated
identifiers and texts keep their rows; an empty table gives no rows; other columns are
ignored.  A place whose first words are missing may start before the text.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What stands between words: ASCII but for letters (A-Z are lower-cased first) and digits.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Per cent of a notice's words that must agree.
SHARE = 80


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    must: tuple[bool, ...]      # word of a mandatory key phrase
    need: int                   # words that must agree
    base: bool = False


def phrase(label: str, text: str) -> Template:
    """All words, consecutively."""
    words = tuple(text.split())
    return Template(label, words, (True,) * len(words), len(words), True)


def notice(label: str, text: str, *keys: str) -> Template:
    """Most words of a notice, all words of its key phrases."""
    words = tuple(text.split())
    must = [False] * len(words)
    for key in keys:
        k = tuple(key.split())
        at = next(i for i in range(len(words)) if words[i:i + len(k)] == k)
        must[at:at + len(k)] = [True] * len(k)
    return Template(label, words, tuple(must), max(sum(must), -(-SHARE * len(words) // 100)))


# Phrases whose every place counts.
BASE = (phrase("mit", "under the mit license"), phrase("apache-2", "apache license version 2"), phrase("cc-by-nc", "cc by nc"))

# Opening words of public licence texts and usual notices, with their key phrases.
NOTICES = (
    notice("mit", "released under the mit license", "the mit license"),
    notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                  "documentation files", "hereby granted free of charge"),
    notice("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    notice("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is "
                       "distributed on an as is basis", "distributed on an as is basis"),
    notice("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    notice("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", "attribution noncommercial"),
    notice("cc-by-sa", "creative commons attribution sharealike 4 0 international license", "attribution sharealike"),
    notice("cc-by", "creative commons attribution 4 0 international license", "commons attribution 4"),
    notice("cc0", "cc0 1 0 universal public domain dedication", "public domain dedication"),
    notice("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    notice("gpl-3", "modify it under the terms of the gnu general public license as published by the free software foundation "
                    "either version 3", "the gnu general public license", "either version 3"),
    notice("gpl-2", "this work is licensed under the gnu general public license version 2", "gnu general public license version 2"),
    notice("gpl-2", "modify it under the terms of the gnu general public license as published by the free software foundation "
                    "either version 2", "the gnu general public license", "either version 2"),
    notice("lgpl-3", "licensed under the gnu lesser general public license version 3", "lesser general public license version 3"),
    notice("agpl-3", "licensed under the gnu affero general public license version 3", "affero general public license version 3"),
    notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
                  "following conditions are met", "source and binary forms", "are permitted provided that"),
    notice("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2"),
    notice("epl-2", "made available under the terms of the eclipse public license 2 0", "eclipse public license 2"),
    notice("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
                  "granted", "with or without fee is hereby granted"),
    notice("zlib", "this software is provided as is without any express or implied warranty", "without any express or implied warranty"),
    notice("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)
TEMPLATES = BASE + NOTICES


def weight(n_docs: int, n_with: int) -> int:
    """Inverse document frequency of a word in thousandths, 1 at least."""
    return 1 + math.floor(1000 * math.log((n_docs + 1) / (n_with + 1)))


def with_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and words: what stands between separators, without the empty strings at the ends."""
    lower = F.translate(F.coalesce(F.col(text_col), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    cut = docs.select(F.col(id_col).alias("doc_id"), F.split(lower, BETWEEN).alias("cut"))
    lead = (F.get("cut", F.lit(0)) == "").cast("int")
    trail = ((F.size("cut") > 1) & (F.element_at("cut", -1) == "")).cast("int")
    return cut.select("doc_id", F.slice("cut", 1 + lead, F.size("cut") - lead - trail).alias("words"))


def word_weights(words: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, int]:
    """Weights of the templates' words over all rows of ``words`` (column ``words``)."""
    known = sorted({w for t in templates for w in t.words})
    held = words.select(F.array_intersect("words", F.lit(known)).alias("held"))
    counts = (held.select(F.explode(F.concat("held", F.array(F.lit("")))).alias("w")).groupBy("w").count().collect())  # one row per template word
    n = {r["w"]: r["count"] for r in counts}
    return {w: weight(n.get("", 0), n.get(w, 0)) for w in known}


def rare_positions(t: Template, weights: dict[str, int]) -> list[int]:
    """Positions under which the template is indexed, rarest first: one of them agrees wherever enough words do."""
    by_rarity = sorted(range(len(t.words)), key=lambda p: (-weights[t.words[p]], p))
    return by_rarity[:len(t.words) - t.need + 1]


def find(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, places: array of (label, base, start, n: words of the template, got, total: weights that agree, of all)."""
    words = with_words(docs, id_col, text_col)
    weights = word_weights(words, templates)
    rare = [rare_positions(t, weights) for t in templates]
    postings: dict[str, list] = {}
    for k, (t, at) in enumerate(zip(templates, rare)):
        for r, p in enumerate(at):
            postings.setdefault(t.words[p], []).append(F.struct(F.lit(k).alias("t"), F.lit(p).alias("p"), F.lit(r).alias("r")))
    index = F.create_map(*[c for w, ps in sorted(postings.items()) for c in (F.lit(w), F.array(*ps))])
    table = F.array(*[F.struct(F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), F.lit(list(t.words)).alias("words"),
                               F.lit([weights[w] for w in t.words]).alias("weights"), F.lit(list(t.must)).alias("must"),
                               F.lit(t.need).alias("need"), F.lit(at).alias("rare")) for t, at in zip(templates, rare)])
    looked_up = sorted(postings)
    hit = F.filter(F.transform("words", lambda w, i: F.when(w.isin(looked_up), F.struct(i.alias("i"), w.alias("w")))), lambda h: h.isNotNull())
    rows = words.select("doc_id", F.size("words").cast("long").alias("n_words"), "words",
                        F.when(F.arrays_overlap("words", F.lit(looked_up)), hit).otherwise(F.filter(hit, lambda h: F.lit(False))).alias("hits"))
    # every posting of a word proposes one place of its template
    proposed = F.flatten(F.transform("hits", lambda h: F.transform(F.element_at(index, h["w"]), lambda q: F.struct(
        F.element_at(table, q["t"] + 1).alias("t"), (h["i"] - q["p"]).alias("start"), q["r"].alias("r")))))
    agreed = F.transform(proposed, lambda c: F.struct(c["t"].alias("t"), c["start"].alias("start"), c["r"].alias("r"), F.transform(
        c["t"]["words"], lambda w, j: F.coalesce(F.get(F.col("words"), c["start"] + j) == w, F.lit(False))).alias("same")))
    kept = F.filter(agreed, lambda c: (F.size(F.filter(c["same"], lambda s: s)) >= c["t"]["need"])
                    & F.forall(F.zip_with(c["same"], c["t"]["must"], lambda s, m: s | ~m), lambda x: x)
                    & ~F.exists(F.slice(c["t"]["rare"], 1, c["r"]), lambda p: F.get(c["same"], p)))
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, w: s + w)
    places = F.transform(kept, lambda c: F.struct(
        c["t"]["label"].alias("label"), c["t"]["base"].alias("base"), c["start"].cast("long").alias("start"),
        F.size(c["t"]["words"]).alias("n"),
        total(F.zip_with(c["same"], c["t"]["weights"], lambda s, w: F.when(s, w).otherwise(0))).alias("got"),
        total(c["t"]["weights"]).alias("total")))
    return rows.select("doc_id", "n_words", F.when(F.size("hits") > 0, places).otherwise(F.filter(places, lambda p: F.lit(False))).alias("places"))


def scan(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])

    def joined(places):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    best = F.array_max(F.transform("places", lambda p: F.round(p["got"] / p["total"], 4)))
    return find(docs, **options).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"), joined(F.col("places")).alias("labels"),
        F.coalesce(best, F.lit(0.0)).alias("score"))


def _sql() -> str:
    rows = ", ".join(f"({k}, {t.base}, '{t.label}', {t.need}, {sum(t.must)}, {p}, '{w}', {m})"
                     for k, t in enumerate(TEMPLATES) for p, (w, m) in enumerate(zip(t.words, t.must)))
    return rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
       translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{BETWEEN.replace('[', '[^', 1)}') AS ws FROM documents),
t(t, base, label, need, n_must, p, w, must) AS (VALUES {rows}),
u AS MATERIALIZED (SELECT * FROM (SELECT rid, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d) WHERE w IN (SELECT w FROM t)),
f AS (SELECT w, count(DISTINCT rid) AS n FROM u GROUP BY w),
x AS (SELECT t.*, 1 + floor(1000 * ln(((SELECT count(*) FROM d) + 1) / (coalesce(f.n, 0) + 1)))::BIGINT AS weight FROM t LEFT JOIN f USING (w)),
y AS (SELECT *, sum(weight) OVER (PARTITION BY t) AS total FROM x),
a AS (SELECT rid, t, i - p AS start, any_value(base) AS base, any_value(label) AS label, sum(weight) AS got, any_value(total) AS total
      FROM u JOIN y USING (w) GROUP BY rid, t, i - p
      HAVING count(*) >= any_value(need) AND count(*) FILTER (must) = any_value(n_must)),
g AS (SELECT rid, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(round(got / total, 4)) AS score
      FROM a GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM d LEFT JOIN g USING (rid)
"""


SQL = _sql()
