"""Near-duplicate lines by an exact set-similarity join; DataFrame operations only.

A line is the set of its words. Words are ordered by rarity over the whole corpus, and two sets that are similar enough
share a word among the first few of that order (the prefix). Lines meet on prefix words; length, position and a parity
signature rule out most pairs, and the Jaccard similarity of the rest is verified on the whole sets.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import discard, stored

#: Words are counted in this many buckets of their hash (a power of two), whatever the vocabulary: any order of words is
#: correct, so a bucket's count will do for rarity, and the ranks are a table of this size.
_BUCKET_BITS = 18
_BUCKETS = 1 << _BUCKET_BITS
#: Columns of parity bits in the index, 64 in each.
_SIGNS = ("s0", "s1", "s2", "s3")
#: The list of lines to verify is broadcast if there are at most this many; else texts and list are shuffled.
_PICKED = 1 << 18
#: Sets meet within classes of size, each this power of the threshold wide.
_CLASS = 4


def _texts(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, text``; the digest tells rows of one id apart. Null texts count as empty."""
    texts = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "coalesce(CAST(text AS STRING), '') AS text")
    return texts.selectExpr("doc_id", "xxhash64(text) & 4294967295 AS digest", "text")


def _words(texts: DataFrame) -> DataFrame:
    """``doc_id, place, words``: a row for each line that has words, with its words, repeats included.

    Words are what stands between white space of ASCII, lower-cased. ``place`` is digest and line number in one.
    """
    lines = texts.selectExpr("doc_id", "digest", "posexplode(split(text, '\n')) AS (line, words)")
    return _split(lines.selectExpr("doc_id", "digest << 31 | line AS place", "words"))


def _split(lines: DataFrame) -> DataFrame:
    """``lines`` that have words, with ``words``, the text of a line, split into them."""
    trimmed = lines.selectExpr("doc_id", "place", "trim(BOTH ' \t\r\f\u000B' FROM lower(words)) AS words")
    return trimmed.where("words <> ''").selectExpr("doc_id", "place", "split(words, '[ \t\r\f\u000B]+') AS words")


def _hashed(lines: DataFrame) -> DataFrame:
    """``doc_id, place, k1, k2, hashes``: the line's set of words by a key of 128 bits and by 32 bits of each word."""
    distinct = F.sort_array(F.array_distinct(F.transform("words", lambda w: F.xxhash64(w))))
    return lines.select("doc_id", "place", distinct.alias("h")).selectExpr(
        "doc_id",
        "place",
        "xxhash64(h) AS k1",
        "xxhash64(1, h) AS k2",
        "transform(h, x -> CAST(x >> 32 AS INT)) AS hashes",
    )


def _ranks(hashed: DataFrame) -> Column:
    """An array literal: for each bucket four times the binary logarithm of its number of words, rounded down."""
    words = hashed.selectExpr("explode(hashes) AS h").selectExpr(f"h & {_BUCKETS - 1} AS bucket")
    ranks = [0] * _BUCKETS
    for bucket, count in words.groupBy("bucket").count().collect():  # at most _BUCKETS rows
        ranks[bucket] = int(4 * math.log2(count))
    return F.from_json(F.lit(json.dumps(ranks, separators=(",", ":"))), "array<int>")


def _sets(hashed: DataFrame, ranks: Column, percent: int) -> DataFrame:
    """``doc_id, place, n, s0..s3, prefix`` of each different set, at its first line.

    ``s0`` to ``s3`` have a bit each for whether an odd number of words falls on it; ``prefix`` has the hashes of the rarest
    words, as many as two similar sets cannot both do without.
    """
    ranked = F.transform(
        "hashes",
        lambda h: F.shiftleft(F.get(ranks, h.bitwiseAND(F.lit(_BUCKETS - 1))).cast("long"), 32).bitwiseOR(
            h.cast("long").bitwiseAND(F.lit((1 << 32) - 1))
        ),
    )
    rows = hashed.select("doc_id", "place", "k1", "k2", F.sort_array(ranked).alias("t")).selectExpr("*", "size(t) AS n")
    # smaller sets are similar enough to equal ones only
    rows = rows.where(f"n * {100 - percent} >= {percent}").selectExpr(
        "doc_id",
        "place",
        "k1",
        "k2",
        "n",
        *_signatures("t"),
        f"transform(slice(t, 1, n - CAST(({percent} * n + 99) div 100 AS INT) + 1), x -> CAST((x << 32) >> 32 AS INT)) AS prefix",
    )
    sets = rows.groupBy("k1", "k2").agg(
        F.min(F.struct("doc_id", "place")).alias("at"), *(F.first(c).alias(c) for c in ("n", *_SIGNS, "prefix"))
    )
    return sets.select("at.*", "n", *_SIGNS, "prefix")


def _overlap(n: str, m: str, percent: int) -> str:
    """How many words two similar sets of these sizes share at least."""
    return f"(({percent} * ({n} + {m}) + {99 + percent}) div {100 + percent})"


def _similar(a: str, b: str, percent: int) -> str:
    """Length, position and signature filters on the columns of two prefix rows; what fails is not similar enough.

    Two similar sets pass at the first word of the order that they share: what comes before it, in either, is not in the
    other, and all that they share is yet to come.
    """
    overlap = _overlap(f"{a}.n", f"{b}.n", percent)
    apart = " + ".join(f"bit_count({a}.{s} ^ {b}.{s})" for s in _SIGNS)
    return (
        f"{a}.n * 100 >= {b}.n * {percent} AND {b}.n * 100 >= {a}.n * {percent}"
        f" AND {a}.p + {b}.p <= {a}.n + {b}.n - 2 * {overlap}"
        f" AND least({a}.n - {a}.p, {b}.n - {b}.p) >= {overlap}"
        f" AND {apart} <= {a}.n + {b}.n - 2 * {overlap}"
    )


def _classed(words: DataFrame, percent: int) -> DataFrame:
    """The rows of ``words`` with ``meeting``, their word and class of size in one, and whether they are at ``home`` there.

    Each row is in the class of its size and, as a guest, in the next one if that has larger sets in reach. Of two similar
    sets in different classes the smaller is a guest of the larger, and the first word that they share is in its short prefix.
    """
    width = _CLASS * math.log(100 / percent) or 1.0
    own = f"CAST(floor(ln(n) / {width}) AS INT)"
    next_too = f"floor(ln(n * 100 / {percent}) / {width}) > {own} AND p <= n - {_overlap('n', 'n', percent)}"
    rows = words.selectExpr("*", f"explode(if({next_too}, array({own}, {own} + 1), array({own}))) AS class")
    return rows.selectExpr("CAST(token AS BIGINT) << 16 | class AS meeting", f"class = {own} AS home", *words.columns)


_LATER = "struct(a.doc_id, a.place) > struct(b.doc_id, b.place)"


def _pairs(later: DataFrame, earlier: DataFrame, percent: int) -> DataFrame:
    """Places of ``later`` and ``earlier`` sets that share a prefix word and pass the filters."""
    joined = later.alias("a").join(earlier.alias("b"), "token")
    return joined.where(f"{_similar('a', 'b', percent)} AND {_LATER}").selectExpr(
        "a.doc_id AS doc_id", "a.place AS place", "b.doc_id AS other_id", "b.place AS other"
    )


def _candidates(words: DataFrame, percent: int) -> DataFrame:
    """Pairs of places, and whether the earlier is the ``head``.

    The sets of one size that share a prefix word have their earliest as head. A set meets those of its class of size. A set that seems similar to the head is
    paired with it alone at this word, else with all earlier sets of the word: groups of many similar sets yield a pair
    for each set, not all pairs. Sets that turn out not to be similar to their head are paired anew by the caller.
    """
    group = Window.partitionBy("meeting", "n").orderBy("doc_id", "place").rowsBetween(Window.unboundedPreceding, 0)
    # both sides of the join have the same rows and columns, and so one exchange; the window keeps its order. The filters,
    # which all rows pass, are those that Spark would add on one side.
    spread = _classed(words, percent).select("meeting", "home", "doc_id", "place", "n", "p", *_SIGNS)
    spread = spread.where(" AND ".join(f"{c} IS NOT NULL" for c in ("meeting", "n", "p", *_SIGNS))).repartition("meeting")
    # a struct of these would travel through the sort beside the columns
    heads = {f"head_{c}": F.first(c).over(group) for c in ("doc_id", "place", "n", "p", *_SIGNS)}
    headed = spread.withColumns(heads).withColumn("head", F.struct(*(F.col(f"head_{c}").alias(c) for c in ("doc_id", "place", "n", "p", *_SIGNS))))
    alike = f"{_similar('a', 'head', percent)} AND NOT (a.doc_id <=> head.doc_id AND a.place = head.place)"
    headed = headed.alias("a").withColumn("alike", F.expr(alike)).where("home OR NOT alike")
    # two guests of a class meet where they are at home
    meet = f"a.meeting = b.meeting AND NOT alike AND (a.home OR b.home) AND {_similar('a', 'b', percent)} AND {_LATER}"
    joined = headed.alias("a").join(spread.alias("b"), F.expr(meet), "left").where("alike OR b.place IS NOT NULL")
    return joined.selectExpr(
        "a.doc_id AS doc_id",
        "a.place AS place",
        "if(alike, head.doc_id, b.doc_id) AS other_id",
        "if(alike, head.place, b.place) AS other",
        "alike AS head",
    )


def _picked(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc_id, place, words`` of the ``wanted`` lines (``doc_id, place``); no other line of a text is split into words."""
    lists = wanted.groupBy("doc_id", F.expr("place >> 31").alias("digest")).agg(F.collect_list("place").alias("places"))
    lists = lists.select(F.struct("*").alias("list"))
    if wanted.count() <= _PICKED:
        lists = F.broadcast(lists)
    held = texts.join(lists, F.expr("doc_id <=> list.doc_id AND digest = list.digest"))
    lines = held.selectExpr("doc_id", "split(text, '\n') AS lines", "explode(list.places) AS place")
    return _split(lines.selectExpr("doc_id", "place", "lines[CAST(place & 2147483647 AS INT)] AS words"))


def _signatures(words: str) -> list[str]:
    """SQL for 256 bits of a set of hashes, in four columns: a bit says whether an odd number of words falls on it."""
    return [
        f"aggregate({words}, 0L, (a, x) -> if((shiftrightunsigned(x, 6) & 3) = {k}, a ^ shiftleft(1L, CAST(x & 63 AS INT)), a)) AS s{k}"
        for k in range(4)
    ]


def _verified(texts: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Places of later sets whose Jaccard similarity with an earlier one is high enough, by 64 bits of each word.

    Pairs meet signatures of 256 bits first. Sets differ in as many words as their signatures in bits, at least; only pairs
    that may yet be similar meet the words, which are many times larger.
    """
    wanted = pairs.select("doc_id", "place").unionByName(pairs.selectExpr("other_id AS doc_id", "other AS place"))
    wanted = stored(wanted.distinct(), "wanted")
    lines = _picked(texts, wanted)
    sets = lines.select("doc_id", "place", F.array_distinct(F.transform("words", lambda w: F.xxhash64(w))).alias("h"))
    sets = stored(sets.distinct().selectExpr("*", "size(h) AS n", *_signatures("h")), "sets")
    mine = sets.selectExpr("doc_id AS id", "place AS at", "n", *_SIGNS)
    other = sets.selectExpr("doc_id AS id", "place AS at", "n AS m", *(f"{s} AS t{s[1:]}" for s in _SIGNS))
    near = pairs.join(mine, F.expr("doc_id <=> id AND place = at")).drop("id", "at")
    near = near.join(other, F.expr("other_id <=> id AND other = at")).drop("id", "at")
    apart = " + ".join(f"bit_count(s{k} ^ t{k})" for k in range(4))
    near = near.where(f"{apart} <= n + m - 2 * (({percent} * (n + m) + {99 + percent}) div {100 + percent})")
    near = near.select("doc_id", "place", "other_id", "other")
    # pairs lie by their other set already
    theirs = sets.selectExpr("doc_id AS id", "place AS at", "h AS theirs")
    both = near.join(theirs, F.expr("other_id <=> id AND other = at")).drop("id", "at", "other_id", "other")
    both = both.join(sets.selectExpr("doc_id AS id", "place AS at", "h AS mine"), F.expr("doc_id <=> id AND place = at"))
    both = both.selectExpr("doc_id", "place", "size(array_intersect(mine, theirs)) AS same", "size(mine) + size(theirs) AS n")
    verified = both.where(f"same * {100 + percent} >= n * {percent}").select("doc_id", "place").distinct()
    verified = stored(verified, "verified")
    discard(sets)
    discard(wanted)
    return verified


def _without(rows: DataFrame, done: DataFrame) -> DataFrame:
    return rows.alias("r").join(done.alias("d"), F.expr("r.doc_id <=> d.doc_id AND r.place = d.place"), "left_anti")


def _near(texts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """First lines of sets for which there is a similar set with an earlier first line.

    One similar earlier set is enough, so each set is first held against the earliest of its candidates, then, if that
    fails, against all; sets that were paired with heads only are paired with all at last.
    """
    words = sets.selectExpr("doc_id", "place", "n", *_SIGNS, "posexplode(prefix) AS (p, token)")
    pairs = stored(_candidates(words, percent), "pairs")
    earliest = pairs.groupBy("doc_id", "place").agg(F.min(F.struct("other_id", "other")).alias("first"))
    found = _verified(texts, earliest.select("doc_id", "place", "first.*"), percent)
    left = stored(_without(pairs, found), "left")
    discard(pairs)
    more = _verified(texts, left.drop("head").distinct(), percent)
    rest = _without(left.where("head").select("doc_id", "place").distinct(), more)
    rest = stored(words.alias("w").join(rest.alias("s"), F.expr("w.doc_id <=> s.doc_id AND w.place = s.place"), "left_semi"), "rest")
    discard(left)
    again = stored(_pairs(rest, words, percent).distinct(), "pairs")
    last = _verified(texts, again, percent)
    discard(again)
    discard(rest)
    return found.unionByName(more).unionByName(last).distinct()


def removed_lines(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, digest, removed``: the numbers of a document's lines, from 0, that match an earlier line.

    Lines are in the order of ``doc_id`` and of their place in the text; rows of one ``doc_id`` with different texts are
    told apart, equal rows are one document. A line matches an earlier one, removed or not, if the Jaccard similarity of
    their sets of words is at least ``percent`` hundredths. Lines without a word match nothing.

    Equal sets are grouped by a key of 128 bits and represented by their first line. In a group of many similar sets
    nearly all match the earliest, which they meet first; only sets without a match so far meet the others. No line is
    missed, and the pairs of a group are not all made.
    """
    texts = _texts(docs)
    lines = stored(_hashed(_words(texts)), "lines")
    firsts = lines.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "place")).alias("at"), F.count(F.lit(1)).alias("copies"))
    copies = lines.select("doc_id", "place", "k1", "k2").join(firsts.where("copies > 1"), ["k1", "k2"])
    copies = stored(copies.where("struct(doc_id, place) > at").select("doc_id", "place").distinct(), "copies")
    sets = stored(_sets(lines, _ranks(lines), percent), "sets")
    discard(lines)  # the largest table; nothing below reads it
    near = _near(texts, sets, percent)
    discard(sets)
    places = copies.unionByName(near).selectExpr(
        "doc_id", "place >> 31 AS digest", "CAST(place & 2147483647 AS INT) AS line"
    )
    return places.groupBy("doc_id", "digest").agg(F.sort_array(F.collect_list("line")).alias("removed"))


def deduplicate(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with ``text`` free of lines that match an earlier line, ``n_chars`` (if there) of the new text, and two
    columns more, ``n_lines`` (before) and ``removed_lines``, which replace columns of these names.

    Every row stays, a document whose lines all go with an empty text. A null text stays null and has one line, the empty
    one. Line ends are LF; a CR before it belongs to the line, as white space. An empty table gives no rows.
    """
    removed = removed_lines(docs, percent).select(F.struct("doc_id", "digest", "removed").alias("hit"))
    rows = docs.select(F.struct("doc_id", "text").alias("key"), F.struct("*").alias("row"))
    same = "CAST(key.doc_id AS BIGINT) <=> hit.doc_id AND xxhash64(coalesce(CAST(key.text AS STRING), '')) & 4294967295 = hit.digest"
    lines = "split(CAST(key.text AS STRING), '\n')"
    rows = rows.withColumn("n_lines", F.expr(f"coalesce(size({lines}), 1)"))
    rows = rows.join(removed, F.expr(same), "left").selectExpr(
        "row", "key.text AS text", "n_lines", f"{lines} AS lines", "hit.removed AS removed"
    )
    kept = "transform(array_except(sequence(0, size(lines) - 1), removed), i -> lines[i])"
    rows = rows.selectExpr(
        "row",
        f"CASE WHEN removed IS NULL THEN text ELSE array_join({kept}, '\n') END AS text",
        "n_lines",
        "coalesce(removed, CAST(array() AS ARRAY<INT>)) AS removed_lines",
    )
    out = []
    for name in docs.columns:
        if name == "text":
            out.append(F.col("text"))
        elif name == "n_chars":
            out.append(F.length("text").cast(docs.schema[name].dataType).alias(name))
        elif name not in ("n_lines", "removed_lines"):
            out.append(F.col("row").getField(name).alias(name))
    return rows.select(*out, "n_lines", "removed_lines")
