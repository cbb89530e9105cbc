"""SpotSigs fingerprints; DataFrame operations only.

A signature is a chain of content words that follows a common word (the anchor). A text's fingerprint is its set of
signatures. Sets are partitioned by their size, and compared only within reach of the threshold, through the few rarest
signatures of each set (the prefix) and an exact Jaccard similarity.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import components, discard, parity_bits, parts_of, stored

#: Common words of English, German, French and Spanish that can be anchors.
ANCHORS = (
    "a an and are as at be by for from has have he her his in is it its of on or she that the they this to was were "
    "which will with you auf das dass dem den der des die ein eine einem einen einer es für ich im ist mit nicht sich "
    "sie und von war wie zu au aux ce dans de du elle en est et il la le les mais ne ou où par pas pour que qui se sur "
    "un une con del el ella era está ha las lo los más no para pero por su sus te una y"
).split()
#: Sets that share a prefix signature are first compared with this many of them alone.
_PIVOTS = 3
#: Rounds of pivots; in the later ones only sets of groups that don't hang together yet meet new pivots.
_ROUNDS = 3
#: Signatures are counted in this many buckets (a power of two); any order of signatures is correct, rare ones first is cheap.
_BUCKETS = 1 << 18
#: Columns of parity bits, 64 in each.
_SIGNS = ("s0", "s1", "s2", "s3")


def with_signatures(df: DataFrame, text: str, out: str, chain: int = 2, anchors: list[str] = ANCHORS) -> DataFrame:
    """``df`` with ``out``: the sorted set of signatures of the column ``text``, as 64-bit hashes.

    Words are runs of letters and digits, lower-cased. Each anchor gives the hash of itself and of the ``chain`` content
    words after it (fewer at the end of the text; none, no signature). A text in which no anchor has a content word after
    it gives the chains from each of its words instead; one without words gives none. Null counts as empty.
    """

    def is_anchor(word: Column) -> Column:
        return word.isin(list(anchors))

    words, content, spots = (f"_{out}_{part}" for part in ("words", "content", "spots"))
    lower = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    df = df.withColumn(words, F.filter(F.split(lower, r"[^\p{L}\p{Nd}]+"), lambda w: w != ""))
    at = F.transform(words, lambda w, i: F.when(is_anchor(w), F.lit(-1)).otherwise(i))
    df = df.withColumn(content, F.filter(at, lambda i: i >= 0))
    none = F.array().cast("array<bigint>")

    def chained(position: Column, k: Column) -> Column:
        before = F.coalesce(F.get(content, k - 1), F.lit(-1))
        follow = [F.get(words, F.get(content, k + j)) for j in range(chain)]
        run = F.transform(F.sequence(before + 1, position - 1), lambda a: F.xxhash64(F.get(words, a), *follow))
        return F.when(position - before > 1, run).otherwise(none)

    df = df.withColumn(spots, F.flatten(F.transform(content, chained)))
    every = F.transform(words, lambda w, i: F.xxhash64(w, *(F.get(words, i + j) for j in range(1, chain))))
    chosen = F.when(F.size(spots) > 0, F.col(spots)).otherwise(every)
    return df.withColumn(out, F.sort_array(F.array_distinct(chosen))).drop(words, content, spots)


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two sets of signatures; that of two empty ones is 1."""
    same = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(same / (F.size(a) + F.size(b) - same))


#: Stands for a null ``doc_id`` in keys; as the smallest long it comes first, as nulls do.
_NULL_ID = -(1 << 63)


def _texts(docs: DataFrame) -> DataFrame:
    """``id, digest, text``: ``id`` and ``digest`` are a document's key. Rows equal in both are one document."""
    rows = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "coalesce(CAST(text AS STRING), '') AS text")
    return rows.select(F.coalesce("doc_id", F.lit(_NULL_ID)).alias("id"), F.xxhash64("text").alias("digest"), "text")


def _ranges(rows: DataFrame, rows_per_range: int, most: int) -> list[tuple[int, int]]:
    """The smallest key of each of at most about ``most`` ranges of keys, in order."""
    keys = stored(rows.select("id", "digest").distinct(), "keys")
    parts = min(parts_of(keys.count(), rows_per_range), most)
    ranged = keys.repartitionByRange(parts, "id", "digest").withColumn("part", F.spark_partition_id())
    heads = ranged.groupBy("part").agg(F.min(F.struct("id", "digest")).alias("head"))
    return sorted(tuple(r.head) for r in heads.collect())  # a row for each range


def with_next_text(docs: DataFrame, rows_per_range: int = 2_000, most_ranges: int = 4_096) -> DataFrame:
    """``id, digest, text, next_text`` of every row; the next document is that of the next key in ascending order, the
    first after the last.

    Texts move once, to the range of their key. The first document of a range goes to the end of the range before as
    well (that of the first to the end of the last), so each range can tell what follows its documents.
    """
    rows = _texts(docs)
    heads = _ranges(rows, rows_per_range, most_ranges)
    if not heads:
        return rows.withColumn("next_text", F.col("text"))
    table = [{"id": i, "digest": d} for i, d in heads]
    literal = F.from_json(F.lit(json.dumps(table)), "array<struct<id:bigint,digest:bigint>>")
    key = F.struct("id", "digest")
    part = F.size(F.filter(literal, lambda h: h <= key)) - 1
    rows = rows.withColumn("own", part)
    first = F.get(literal, F.col("own")) == key
    before = F.pmod(F.col("own") - 1, F.lit(len(heads)))
    places = F.array(F.struct(F.col("own").alias("part"), F.lit(False).alias("copy")))
    copies = F.array(F.struct(before.alias("part"), F.lit(True).alias("copy")))
    rows = rows.withColumn("place", F.explode(F.when(first, F.concat(places, copies)).otherwise(places)))
    rows = rows.select("id", "digest", "text", "place.part", "place.copy")
    ranked = rows.withColumn("number", F.dense_rank().over(Window.partitionBy("part").orderBy("copy", "id", "digest")))
    following = Window.partitionBy("part").orderBy("number").rangeBetween(1, 1)
    return ranked.withColumn("next_text", F.first("text").over(following)).where("NOT copy").drop("part", "copy", "number")


def _ranks(sets: DataFrame) -> Column:
    """An array literal: for each bucket of signatures four times the binary logarithm of their number in ``own``, rounded down."""
    # explode would filter by size(own), and Spark compute signatures anew for that, word by word
    counts = sets.selectExpr("explode_outer(own) AS s").groupBy(F.expr(f"CAST(s & {_BUCKETS - 1} AS INT)").alias("bucket")).count()
    ranks = [0] * _BUCKETS
    for bucket, count in counts.where("bucket IS NOT NULL").collect():  # at most _BUCKETS rows
        ranks[bucket] = int(4 * math.log2(count))
    return F.from_json(F.lit(json.dumps(ranks, separators=(",", ":"))), "array<int>")


def _prefix(own: str, ranks: Column, percent: int) -> Column:
    """The rarest signatures of a set, as many as two similar sets cannot both do without; none of a set so small that
    only equal ones are similar enough."""
    rank = F.transform(own, lambda s: F.struct(F.get(ranks, s.bitwiseAND(F.lit(_BUCKETS - 1)).cast("int")).alias("r"), s.alias("s")))
    size = F.size(own)
    count = size - F.expr(f"CAST(({percent} * size({own}) + 99) div 100 AS INT)") + 1
    rarest = F.transform(F.slice(F.sort_array(rank), 1, count), lambda x: x["s"])
    return F.when(size * (100 - percent) >= percent, rarest).otherwise(F.array().cast("array<bigint>"))


def _banded(sets: DataFrame, ranks: Column, percent: int) -> DataFrame:
    """``signature, node, n, p, band, s0..s3`` for each set and prefix signature that two sets or more have.

    ``p`` is the place in the prefix, ``s0`` to ``s3`` are parity bits of the whole set; sets of one ``band`` of sizes, or of
    neighbouring ones, are in reach.
    """
    band = f"CAST(floor(ln(n) / ln({100 / percent})) AS INT)"
    known = sets.select("node", "n", F.expr(band).alias("band"), *parity_bits("own"), _prefix("own", ranks, percent).alias("prefix"))
    known = stored(known.where("size(prefix) > 0"), "prefixes")
    # parity bits are many times a signature's size; they are joined to what is left
    rows = known.selectExpr("node", "posexplode(prefix) AS (p, signature)")
    shared = rows.groupBy("signature").agg(F.count(F.lit(1)).alias("shared")).where("shared > 1").select("signature")
    rows = stored(rows.join(shared, "signature"), "shared")
    banded = stored(rows.join(known.drop("prefix"), "node"), "banded")
    discard(known)
    discard(rows)
    return banded


def _apart() -> str:
    """Bits in which the sets of the rows ``a`` and ``b`` differ; they differ in as many signatures at least."""
    return "(" + " + ".join(f"bit_count(a.{s} ^ b.{s})" for s in _SIGNS) + ")"


def _reach(percent: int) -> str:
    """Length, position and parity filters on two prefix rows ``a`` and ``b``; what fails is not similar enough.

    Two similar sets pass at the first signature that they share: all others that they share come after it in both.
    """
    overlap = f"(({percent} * (a.n + b.n) + {99 + percent}) div {100 + percent})"
    return (
        f"a.n * 100 >= b.n * {percent} AND b.n * 100 >= a.n * {percent}"
        f" AND least(a.n - a.p, b.n - b.p) >= {overlap} AND {_apart()} <= a.n + b.n - 2 * {overlap}"
    )


def _to_pivots(rows: DataFrame, percent: int, turn: int = 0) -> DataFrame:
    """``u, v``: each set with the pivot of another part that differs least from it, for each of the ``_PIVOTS`` choices.

    Each group of sets that share a prefix signature and a band has the same number of pivots, whatever its size, and others
    in each ``turn``.
    """
    row = F.struct("node", "part", "n", "p", *_SIGNS)
    chosen = [F.min_by(row, F.xxhash64("node", F.lit(turn * _PIVOTS + k))).alias(f"pivot{k}") for k in range(_PIVOTS)]
    pivots = rows.groupBy("signature", "band").agg(*chosen)
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("choice"), F.col(f"pivot{k}").alias("pivot")) for k in range(_PIVOTS))))
    pivots = pivots.select("signature", "band", each.alias("c")).select("signature", "band", "c.choice", "c.pivot.*")
    met = rows.alias("a").join(pivots.alias("b"), ["signature", "band"]).where(f"a.part <> b.part AND {_reach(percent)}")
    met = met.selectExpr("a.node AS node", "choice", "b.node AS pivot", f"{_apart()} AS apart")
    closest = met.groupBy("node", "choice").agg(F.min(F.struct("apart", "pivot")).alias("to"))
    return closest.selectExpr("least(node, to.pivot) AS u", "greatest(node, to.pivot) AS v").distinct()


def _mixed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` of the signatures whose sets don't all hang together by the links ``found``, with the ``part`` of each set."""
    parts = components(found).withColumnRenamed("component", "part")
    rows = rows.drop("part").join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    several = rows.groupBy("signature").agg(F.min("part").alias("least"), F.max("part").alias("most"))
    return stored(rows.join(several.where("least <> most").select("signature"), "signature"), "mixed")


def _between_parts(rows: DataFrame, percent: int) -> DataFrame:
    """``u, v, pu, pv, apart``: pairs of sets of different parts that pass the filters."""
    probing = rows.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    met = probing.alias("a").join(rows.alias("b"), ["signature", "band"])
    met = met.where(f"a.node < b.node AND a.part <> b.part AND {_reach(percent)}")
    met = met.selectExpr("a.node AS u", "b.node AS v", "a.part AS pu", "b.part AS pv", f"{_apart()} AS apart")
    return stored(met.distinct(), "pairs")


def links(sets: DataFrame, ranks: Column, percent: int) -> DataFrame:
    """``u, v``: links that hold together all ``sets`` (``node, n, own``) with a Jaccard similarity of ``percent`` hundredths
    or more.

    Groups that share a prefix signature don't make all their pairs. Each set first meets the few pivots of its groups;
    those that hang together by that need not meet again, the others meet new pivots in further rounds. Those still apart meet: first the closest pair of two parts, then, of
    parts that are still apart, every pair that passes the filters.
    """
    rows = _banded(sets, ranks, percent)
    found = _verified(sets, _to_pivots(rows.withColumn("part", F.col("node")), percent), percent)
    for turn in range(1, _ROUNDS):
        mixed = _mixed(rows, found)
        discard(rows)
        rows = mixed
        found = found.unionByName(_verified(sets, _to_pivots(rows, percent, turn), percent))
    mixed = _mixed(rows, found)
    discard(rows)
    pairs = _between_parts(mixed, percent)
    discard(mixed)
    closest = pairs.groupBy(F.least("pu", "pv").alias("p"), F.greatest("pu", "pv").alias("q"))
    closest = closest.agg(F.min(F.struct("apart", "u", "v")).alias("pair")).select("pair.u", "pair.v")
    found = found.unionByName(_verified(sets, closest, percent))
    parts = components(found)
    left = pairs.join(parts.selectExpr("node AS u", "component AS cu"), "u", "left").join(
        parts.selectExpr("node AS v", "component AS cv"), "v", "left"
    )
    left = left.where("coalesce(cu, u) <> coalesce(cv, v)").select("u", "v")
    found = found.unionByName(_verified(sets, left, percent))
    discard(pairs)
    return found


def _verified(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs ``u, v`` whose sets are similar enough."""
    pairs = stored(pairs, "pairs")
    wanted = pairs.selectExpr("u AS node").unionByName(pairs.selectExpr("v AS node")).distinct()
    made = sets.select("node", "own").join(wanted, "node", "left_semi")
    both = pairs.join(made.selectExpr("node AS u", "own AS a"), "u").join(made.selectExpr("node AS v", "own AS b"), "v")
    both = both.selectExpr("u", "v", "size(array_intersect(a, b)) AS same", "size(a) + size(b) AS n")
    verified = stored(both.where(f"same * {100 + percent} >= n * {percent}").select("u", "v"), "links")
    discard(pairs)
    return verified


def fingerprints(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_signatures, class_id``.

    The edited text has its last ``floor(n_chars / 2)`` code points replaced by the first as many (or all) of the next
    document's text; documents follow one another by ``doc_id`` and text, the first after the last, so a single document
    follows itself. A fingerprint is written as 32 hexadecimal digits of its set of signatures; ``near_edited`` and
    ``near_next`` are Jaccard similarities of the sets; ``class_id`` is that of :func:`classes`, over all documents. Every
    row gives a row; equal rows are one document in the order. Null texts count as empty, a null ``doc_id`` comes first.
    Other columns are ignored; no rows give none.
    """
    rows = with_next_text(docs).selectExpr(
        "*", "length(text) AS n_chars", "concat(left(text, length(text) - length(text) div 2), left(next_text, length(text) div 2)) AS edited"
    )
    for text, out in (("text", "own"), ("edited", "changed"), ("next_text", "following")):
        rows = with_signatures(rows, text, out)
    columns = [
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        _written("own").alias("fingerprint"),
        _written("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"),
        likeness("own", "following").alias("near_next"),
        F.size("own").alias("n_signatures"),
    ]
    return _classed(docs, rows, columns, percent)


def classes(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, fingerprint, class_id`` of every row.

    Documents whose sets of signatures have a Jaccard similarity of ``percent`` hundredths or more hang together in a
    class, named by its smallest ``doc_id``; texts without a word have the empty set and are one class. Rows of null
    ``doc_id`` name a class only if all in it are null. Other columns are ignored; no rows give none.
    """
    rows = with_signatures(_texts(docs), "text", "own")
    return _classed(docs, rows, [_written("own").alias("fingerprint")], percent)


def _classed(docs: DataFrame, rows: DataFrame, columns: list[Column], percent: int) -> DataFrame:
    """``doc_id``, the ``columns`` of ``rows`` (``id, digest, own`` and more, a row for each of ``docs``) and ``class_id``."""
    doc_id = F.nullif("id", F.lit(_NULL_ID)).alias("doc_id")
    rows = stored(rows.select(doc_id, *columns, F.xxhash64("own").alias("node")), "fingerprints")
    # each text's signatures, once for texts that have the same
    sets = with_signatures(_texts(docs), "text", "own").groupBy(F.xxhash64("own").alias("node"))
    sets = stored(sets.agg(F.first("own").alias("own")).select("node", F.size("own").alias("n"), "own"), "sets")
    labels = components(links(sets, _ranks(sets), percent))
    discard(sets)
    named = rows.groupBy("node").agg(F.min("doc_id").alias("first")).join(labels, "node", "left")
    named = stored(named.select("node", "first", F.coalesce("component", "node").alias("component")), "named")
    smallest = named.groupBy("component").agg(F.min("first").alias("class_id"))
    return rows.join(named.join(smallest, "component").select("node", "class_id"), "node").drop("node")


def _written(signatures: str) -> Column:
    halves = (F.xxhash64(signatures), F.xxhash64(F.lit(1), signatures))
    return F.concat(*(F.lower(F.lpad(F.hex(half), 16, "0")) for half in halves))
