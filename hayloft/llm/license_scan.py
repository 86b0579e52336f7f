"""License scans by diagonal voting, DataFrame functions only.

All rolling ``K``-word hashes of every document are joined to the positions they
have in the license templates. A copy of a template puts its matches on one
diagonal (document position minus template position); words added or dropped
inside shift the rest to a neighbouring one. Matches are gathered by diagonal and
diagonals at most ``SHIFT`` apart are merged. Merged diagonals may hold several
notices, or pieces of them, one after the other; so from every match on, the best
span of at most ``MAX_STRETCH`` times the template's size is voted on, and counts when
it covers enough of the template. No match is left out for the size of what it is
merged with. The templates are a fixed list, so their table is broadcast; the
documents are read once, and of their hashes only those of a template go on.
"""

from __future__ import annotations

from functools import reduce
from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hayloft.llm.tables import ALNUM_WORD, ascii_lower, stored, text_key

K = 3
SHIFT = 3
MIN_COVERAGE = 0.75
MAX_STRETCH = 1.5

# Base phrases and their labels.
PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]

# Notices as the licenses' texts recommend or contain them.
TEMPLATES = [
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction",
    ),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation",
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met",
    ),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted",
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "copyright all rights reserved no part of this work may be reproduced"),
]


def _words(text: str) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text), F.lit(""))), F.lit(f"({ALNUM_WORD})"), F.lit(1))


def _gram_hashes(words: str) -> Column:
    """Hash of each run of ``K`` words, in order; none for shorter texts."""
    at = F.sequence(F.lit(0), F.size(words) - K)
    hashed = F.transform(at, lambda i: F.xxhash64(*[F.get(F.col(words), i + j) for j in range(K)]))
    return F.when(F.size(words) >= K, hashed).otherwise(F.array().cast("array<bigint>"))


def template_positions(spark) -> DataFrame:
    """``template, label, template_words, template_at, gram``: a few hundred rows."""
    values = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(TEMPLATES))
    templates = spark.sql(f"SELECT * FROM VALUES {values} AS t(template, label, text)")
    split = templates.select("template", "label", F.split("text", " ").alias("words"))
    return split.select(
        "template", "label", F.size("words").alias("template_words"), F.posexplode(_gram_hashes("words")).alias("template_at", "gram")
    )


def _phrase_places(words: str) -> Column:
    """``(at, label)`` of every place where a base phrase stands."""
    col = F.col(words)

    def places(parts: list[str], label: str) -> Column:
        def stands(i: Column) -> Column:
            return F.coalesce(reduce(lambda a, b: a & b, [F.get(col, i + j) == p for j, p in enumerate(parts)]), F.lit(False))

        at = F.filter(F.sequence(F.lit(0), F.size(col) - 1), stands)
        return F.transform(at, lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))

    found = [places(phrase.split(), label) for phrase, label in PHRASES]
    none = F.array().cast("array<struct<at:int,label:string>>")
    # every phrase holds this word
    return F.when(F.array_contains(col, "license"), F.concat(*found)).otherwise(none)


def _reach(template_words: int) -> int:
    """How far after the first match of a span its last one may stand."""
    return int(template_words * MAX_STRETCH + SHIFT) - K


def _template_hits(words: str, spark) -> Column:
    """``(at, gram)`` of the rolling hashes that some template has."""
    known = [r.gram for r in template_positions(spark).select("gram").distinct().collect()]  # a few hundred, fixed
    each = F.transform(_gram_hashes(words), lambda g, i: F.struct(i.alias("at"), g.alias("gram")))
    return F.filter(each, lambda x: x["gram"].isin(known))


def template_spans(hits: DataFrame) -> DataFrame:
    """``doc, label, start, end, coverage``: the best span from each match on; ``hits`` has ``doc`` and ``hits``."""
    grams = hits.select("doc", F.explode("hits").alias("hit")).select("doc", "hit.at", "hit.gram")
    matches = grams.join(F.broadcast(template_positions(hits.sparkSession)), "gram")
    matches = matches.withColumn("diagonal", F.col("at") - F.col("template_at"))
    diagonals = matches.groupBy("doc", "template", "diagonal").agg(F.lit(1).alias("one"))
    along = Window.partitionBy("doc", "template").orderBy("diagonal")
    breaks = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(along) > SHIFT).cast("int"), F.lit(0))
    islands = diagonals.withColumn("breaks", breaks).select(
        "doc", "template", "diagonal", F.sum("breaks").over(along).alias("island")
    )
    # places in units in which every template's reach is the same whole number
    reaches = {len(text.split()): _reach(len(text.split())) for _, text in TEMPLATES}
    unit = lcm(*reaches.values())
    scale = reduce(lambda c, r: c.when(F.col("template_words") == r[0], unit // r[1]), reaches.items(), F).cast("long")
    onward = Window.partitionBy("doc", "template", "island").orderBy("place").rangeBetween(0, unit)
    spans = (
        matches.join(islands, ["doc", "template", "diagonal"])
        .withColumn("place", F.col("at") * scale)
        .withColumns({"votes": F.size(F.collect_set("template_at").over(onward)), "stop": F.max("at").over(onward)})
    )
    coverage = F.col("votes") / (F.col("template_words") - (K - 1))
    best = F.max(F.struct(coverage.alias("coverage"), (-(F.col("stop") - F.col("at"))).alias("short"), (-F.col("at")).alias("first")))
    # of the spans that end at the same match the best stands for all
    found = spans.groupBy("doc", "template", "label", "island", "stop").agg(best.alias("b"))
    return found.select(
        "doc", "label", (-F.col("b.first")).alias("start"), (F.col("stop") + K).alias("end"), F.col("b.coverage").alias("coverage")
    )


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """Licenses of every document.

    Returns the id, ``n_words``, ``base_places`` (word offset and label of each
    base phrase), ``spans`` (template spans that pass, with offsets and
    coverage; spans of one notice may overlap), ``labels`` (distinct, sorted) and ``score`` (the best coverage of
    any template; 1 where a base phrase stands, 0 without any match).

    Defined cases: a NULL or empty text has no words and no labels; repeated rows
    are scanned alike; NULL ids are kept; a very long text is scanned whole, and only its
    matches leave its row; an empty table gives an empty table. Further columns
    are not carried.
    """
    keyed = docs.select(
        F.struct(F.col(id_col).alias("id"), text_key(text_col).alias("tkey")).alias("doc"), _words(text_col).alias("words")
    )
    base = stored(
        keyed.select(
            "doc",
            F.size("words").cast("long").alias("n_words"),
            _phrase_places("words").alias("base_places"),
            _template_hits("words", docs.sparkSession).alias("hits"),
        ),
        "license-hits",
    )
    spans = template_spans(base.where(F.size("hits") > 0).dropDuplicates(["doc"]).select("doc", "hits"))
    passed = F.col("coverage") >= min_coverage
    best = spans.groupBy("doc").agg(
        F.max("coverage").alias("best"),
        F.sort_array(F.collect_set(F.when(passed, F.struct("start", "end", "label", "coverage")))).alias("spans"),
    )
    none = F.array().cast("array<struct<start:int,end:int,label:string,coverage:double>>")
    found = base.join(best, "doc", "left").withColumn("spans", F.coalesce("spans", none))
    labels = F.array_union(F.transform("base_places", lambda p: p["label"]), F.transform("spans", lambda s: s["label"]))
    return found.select(
        F.col("doc.id").alias(id_col),
        "n_words",
        "base_places",
        "spans",
        F.sort_array(F.array_distinct(labels)).alias("labels"),
        F.when(F.size("base_places") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
