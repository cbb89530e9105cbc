"""License scans by diagonal voting; DataFrame operations only.

Every pair of neighbouring words of a document is joined to the places of the same pair in the templates. A match votes
for the diagonal (place in the document less place in the template); votes are counted per diagonal, neighbouring
diagonals are merged, so that a few words more or less do not break a match, and the spans are verified by the share of the
template that they cover and by the words in them that tell licenses apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import stored

# Phrases that count wherever their words stand consecutively, and their labels.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
#: Notices that are found in varied wording too, and their labels.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "the software is provided as is without warranty of any kind express or implied": "mit",
    "licensed under the mit license": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache-2.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "gnu general public license as published by the free software foundation either version 2 of the license": "gpl-2.0",
    "gnu general public license as published by the free software foundation either version 3 of the license": "gpl-3.0",
    "under the terms of the gnu lesser general public license": "lgpl",
    "licensed under the gnu lesser general public license": "lgpl",
    "under the terms of the gnu affero general public license": "agpl",
    "licensed under the gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee": "isc",
    "subject to the terms of the mozilla public license": "mpl",
    "this program and the accompanying materials are made available under the terms of the eclipse public license": "epl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "licensed under cc by 4 0": "cc-by-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by nd 4 0": "cc-by-nd-4.0",
    "licensed under cc by nc sa 4 0": "cc-by-nc-sa-4.0",
    "licensed under cc by nc nd 4 0": "cc-by-nc-nd-4.0",
    "licensed under a creative commons attribution license": "cc-by",
}
#: Words that tell one license from another; a notice that has them is verified only with all of them.
TELLING = frozenset("affero apache attribution by cc commons creative eclipse general gnu lesser mit mozilla nc nd sa version 0 2 3 4".split())
#: Words that make another license of one; a span that has one which its notice has not is no such notice.
FORBIDDING = frozenset("affero lesser library nc nd noncommercial noderivatives noderivs sa sharealike".split())
#: The template of the places of single words that tell or forbid.
_MARK = -1
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What parts words: all of ASCII but digits and (lower-cased) letters.
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _templates(spark: SparkSession, base: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """A row for each pair of neighbouring words: ``template, label, exact, pairs`` (their number),
    ``needed`` (the telling words and their places), ``place, w1, w2``; and one for each word that tells or forbids, without ``w2``."""
    rows = []
    for exact, phrases in ((True, base), (False, notices)):
        for phrase, label in phrases.items():
            words = phrase.split()
            if len(words) < 2:
                raise ValueError(f"A phrase needs two words: {phrase}")
            pairs = list(zip(words, words[1:], strict=False))
            needed = [(i, w) for i, w in enumerate(words) if w in TELLING]
            number = len({r[0] for r in rows})
            rows += [(number, label, exact, len(pairs), needed, place, a, b) for place, (a, b) in enumerate(pairs)]
    rows += [(_MARK, word, False, 0, [], 0, word, "") for word in sorted(TELLING | FORBIDDING)]
    schema = "template int, label string, exact boolean, pairs int, needed array<struct<place:int,word:string>>, place int, w1 string, w2 string"
    return spark.createDataFrame(rows, schema)


def _words(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, words`` of every row; the digest tells rows of one id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    words = F.filter(F.split(F.translate("text", _UPPER, _UPPER.lower()), _GAPS), lambda w: w != "")
    return rows.select("doc_id", F.xxhash64("text").alias("digest"), words.alias("words"))


def votes(docs: DataFrame, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES) -> DataFrame:
    """``doc_id, digest, template, label, exact, pairs, needed, diagonal, place``: each match of a pair of words, once; and
    with template -1 each place (``diagonal``) of a word (``label``) that tells or forbids."""
    pairs = F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("w1"), F.get("words", i + 1).alias("w2")))
    marks = F.filter(pairs, lambda g: g["w1"].isin(sorted(TELLING | FORBIDDING)))
    marks = F.transform(marks, lambda g: F.struct(g["at"].alias("at"), g["w1"].alias("w1"), F.lit("").alias("w2")))
    grams = _words(docs).select("doc_id", "digest", F.explode(F.concat(pairs, marks)).alias("gram"))
    grams = grams.select("doc_id", "digest", "gram.*", F.xxhash64("gram.w1", "gram.w2").alias("hash"))
    # the templates are the phrases given as parameters, a few hundred rows
    index = F.broadcast(_templates(docs.sparkSession, base, notices).withColumn("hash", F.xxhash64("w1", "w2")))
    found = grams.join(index, ["hash", "w1", "w2"])
    return found.select(
        "doc_id", "digest", "template", "label", "exact", "pairs", "needed", (F.col("at") - F.col("place")).alias("diagonal"), "place"
    ).distinct()


def spans(matches: DataFrame, least_cover: float = 0.7, slack: int = 2) -> DataFrame:
    """``doc_id, digest, label, exact, start, cover`` of the verified spans.

    A phrase of the base stands where all its pairs vote for one diagonal. For a notice, diagonals of one document at most
    ``2 * slack`` apart are one span, so it is at most that much longer than the notice; it is verified if its different
    pairs are ``least_cover`` of the notice's or more, if each telling word of the notice is in one of them, and if between
    its first word and its last the telling words stand in the notice's order and no forbidding word that the notice has
    not. Of notices that start within ``2 * slack`` words of one another those that are covered best stay.
    """
    key = ["doc_id", "digest", "template", "label", "exact", "pairs", "needed"]
    ends = (F.min("place").alias("low"), F.max("place").alias("high"))
    lines = matches.where(F.col("template") != _MARK)
    lines = lines.groupBy(*key, "diagonal").agg(F.count(F.lit(1)).alias("n"), F.collect_set("place").alias("places"), *ends)
    exact = lines.where("exact AND n = pairs").select("doc_id", "digest", "label", "exact", F.col("diagonal").alias("start"), F.lit(1.0).alias("cover"))
    width = 2 * slack
    within = Window.partitionBy("doc_id", "digest", "template").orderBy("diagonal").rangeBetween(0, width)
    merged = lines.where("NOT exact").withColumn("places", F.array_distinct(F.flatten(F.collect_list("places").over(within))))
    merged = merged.withColumn("low", F.min(F.col("diagonal") + F.col("low")).over(within))
    merged = merged.withColumn("high", F.max(F.col("diagonal") + F.col("high") + 1).over(within))
    told = F.forall("needed", lambda w: F.array_contains("places", w["place"]) | F.array_contains("places", w["place"] - 1))
    merged = merged.withColumn("start", F.col("diagonal")).withColumn("cover", F.size("places") / F.col("pairs"))
    merged = _in_order(merged.where((F.col("cover") >= least_cover) & told), matches)
    nearby = Window.partitionBy("doc_id", "digest").orderBy("start").rangeBetween(-width, width)
    merged = merged.withColumn("best", F.max("cover").over(nearby)).where("cover = best")
    return exact.unionByName(merged.select("doc_id", "digest", "label", "exact", F.greatest("start", F.lit(0)).alias("start"), "cover"))


def _in_order(merged: DataFrame, matches: DataFrame) -> DataFrame:
    """The spans ``low`` to ``high`` whose telling words stand in order and that hold no forbidding word of another license."""
    marks = matches.where(F.col("template") == _MARK).groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
    marks = marks.agg(F.sort_array(F.collect_set(F.struct(F.col("diagonal").alias("at"), F.col("label").alias("word")))).alias("marks"))
    spans = merged.join(marks, F.expr("doc_id <=> _id AND digest = _digest"), "left")
    inside = "filter(coalesce(marks, array()), m -> m.at BETWEEN low AND high)"
    spans = spans.withColumn("inside", F.expr(f"transform({inside}, m -> m.word)"))
    forbidding = ", ".join(f"'{word}'" for word in sorted(FORBIDDING))
    ordered = "aggregate(inside, 0, (k, w) -> if(w <=> get(needed, k).word, k + 1, k)) = size(needed)"
    other = f"exists(inside, w -> w IN ({forbidding}) AND NOT exists(needed, t -> t.word = w))"
    return spans.where(f"{ordered} AND NOT {other}").drop("_id", "_digest", "marks", "inside")


def scan(docs: DataFrame, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every row.

    Words are runs of ASCII letters (lower-cased), digits and all that is not ASCII. ``n_base`` counts the places where a
    base phrase stands, ``first_word`` and ``last_word`` are the smallest and largest start (null without one). ``labels``
    has the base labels and those of verified notices; ``score`` is the greatest cover of a span, 0 without one. Null
    texts count as empty. Equal rows give equal rows, rows of one ``doc_id`` and different texts are judged each for
    itself; other columns are ignored; no rows give none.
    """
    found = spans(stored(votes(docs, base, notices), "votes"))
    start = F.when(F.col("exact"), F.col("start").cast("long"))
    found = found.groupBy("doc_id", "digest").agg(
        F.count(start).alias("n_base"),
        F.min(start).alias("first_word"),
        F.max(start).alias("last_word"),
        _joined(F.when(F.col("exact"), F.col("label"))).alias("base_labels"),
        _joined(F.col("label")).alias("labels"),
        F.max("cover").alias("score"),
    )
    found = found.withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})
    rows = _words(docs).select("doc_id", "digest", F.size("words").cast("long").alias("n_words"))
    rows = rows.join(found, F.expr("doc_id <=> _id AND digest = _digest"), "left")
    return rows.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _joined(label: Column) -> Column:
    return F.array_join(F.sort_array(F.collect_set(label)), ",")
