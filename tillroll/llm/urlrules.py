"""URL filters: stated rules by host and path, and association rules that FP-growth mines from labelled URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import stored

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BAD = "label=bad"


def with_parts(pages: DataFrame) -> DataFrame:
    """``pages`` with ``host`` and ``path``, both empty for a null URL or one without ``://``.

    The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; the path is what
    follows that up to ``?``, ``#`` or the end.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(CAST(url AS STRING), instr(CAST(url AS STRING), '://') + 3)"))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _UPPER.lower())
    return pages.withColumns({"host": host, "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def stated(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """Rule and verdict for ``host`` and ``path`` by ``(verdict, "host/path")`` rules; the longest that fits, else null.

    A rule fits its host and all subdomains of it, if the path starts with the rule's path.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        host, slash, path = text.partition("/")
        fits = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        fits = fits & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def tokens() -> Column:
    """Distinct tokens of ``url, host, path``: host labels and the words of hyphened ones, path segments, extension, query parameters.

    Runs of digits are one token, whatever the number.
    """

    def named(kind: str, parts: Column) -> Column:
        plain = F.transform(parts, lambda p: F.regexp_replace(F.translate(p, _UPPER, _UPPER.lower()), r"[0-9]+", "0"))
        return F.transform(F.filter(plain, lambda p: p != ""), lambda p: F.concat(F.lit(f"{kind}="), p))

    hyphened = F.filter(F.split("host", r"\."), lambda label: F.contains(label, F.lit("-")))
    query = F.regexp_extract("url", r"^[^?#]*\?([^#]*)", 1)
    return F.array_distinct(
        F.concat(
            named("host", F.split("host", r"\.")),
            named("word", F.flatten(F.transform(hyphened, lambda label: F.split(label, "-")))),
            named("path", F.split("path", r"[/.]")),
            named("query", F.split(query, "[&;]")),
            named("fragment", F.split(F.regexp_extract("url", "#(.*)$", 1), ",")),
        )
    )


def mine(urls: DataFrame, min_support: float, min_count: int, min_confidence: float) -> DataFrame:
    """``number, antecedent, confidence, support, rarest``: rules from token combinations to bad pages.

    ``urls`` has ``tokens, bad``. A combination must be on ``min_support`` of the labelled URLs, and on ``min_count`` of
    them, together with a bad label, and ``min_confidence`` of its URLs must be bad. ``rarest`` is its rarest token.

    A token that is on fewer than ``min_count`` bad URLs is in no such combination and is left out before mining, so a
    low count stays within reach on a large table.
    """
    rows = stored(urls.select("tokens", "bad").withColumn("row", F.monotonically_increasing_id()), "labelled")
    n = rows.count()
    telling = rows.where("bad").select(F.explode("tokens").alias("token")).groupBy("token").count().where(F.col("count") >= min_count)
    left = rows.select("row", F.explode("tokens").alias("token")).join(telling.select("token"), "token")
    left = left.groupBy("row").agg(F.collect_list("token").alias("items"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    with_label = F.when(F.col("bad"), F.array_append(items, F.lit(_BAD))).otherwise(items)
    baskets = stored(rows.join(left, "row", "left").select(with_label.alias("items")), "baskets")
    empty = "number bigint, antecedent array<string>, confidence double, support double, rarest string"
    if n < min_count:
        return urls.sparkSession.createDataFrame([], empty)
    model = FPGrowth(
        itemsCol="items", minSupport=min(1.0, max(min_support, min_count / n)), minConfidence=min_confidence
    ).fit(baskets)
    rules = model.associationRules.where(F.col("consequent")[0] == _BAD)
    rules = stored(rules.select(F.sort_array("antecedent").alias("antecedent"), "confidence", "support"), "rules")
    rules = rules.withColumn("number", F.xxhash64("antecedent"))
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    parts = rules.select("number", F.explode("antecedent").alias("token")).join(single, "token")
    rarest = parts.groupBy("number").agg(F.min(F.struct("freq", "token")).alias("least"))
    return rules.join(rarest, "number").select(
        "number", "antecedent", "confidence", "support", F.col("least.token").alias("rarest")
    )


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url, rule_tokens, confidence``: the mined rule of greatest confidence whose tokens are all in ``url, tokens``.

    The inverted index has each rule under its rarest token; only URLs with that token are compared with the rule.
    """
    index = rules.select("rarest", "number", "antecedent", "confidence")
    found = urls.select("url", "tokens", F.explode("tokens").alias("rarest")).join(index, "rarest")
    found = found.where(F.size(F.array_except("antecedent", "tokens")) == 0)
    best = Window.partitionBy("url").orderBy(F.desc("confidence"), "number")
    found = found.select("url", "antecedent", "confidence", "number").withColumn("place", F.row_number().over(best))
    return found.where("place = 1").select("url", F.array_join("antecedent", " ").alias("rule_tokens"), "confidence")


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]],
    min_support: float = 0.0,
    min_count: int = 20,
    min_confidence: float = 0.5,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined_rule, confidence`` of every row of ``pages``.

    The stated rule that fits decides; else a page is blocked if a mined rule fits, and allowed if none does. A page is bad
    if its label (``doc_id`` being the ``page_id``) has quality 0 or toxic 1; pages of one URL are one basket, bad if one
    of them is. The same number of bad URLs makes a rule at every size of the table, unless ``min_support`` asks for a share. Without enough labels there are no mined rules. Null URLs and URLs without ``://`` have an empty host and
    path, no rule, and are allowed. Repeated rows stay rows; other columns are ignored; no rows give none.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    bad = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("page_id")).agg(
        F.max(F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False))).alias("bad")
    )
    split = with_parts(rows)
    known = split.where("url IS NOT NULL").join(bad, "page_id").groupBy("url", "host", "path").agg(F.max("bad").alias("bad"))
    mined = stored(mine(known.select(tokens().alias("tokens"), "bad"), min_support, min_count, min_confidence), "mined")
    urls = split.where("url IS NOT NULL").select("url", "host", "path").distinct().withColumn("tokens", tokens())
    hits = matched(urls, mined)
    rule, verdict = stated(rules)
    hit = F.col("confidence").isNotNull()
    return split.join(hits, "url", "left").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.when(hit, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.col("rule_tokens").alias("mined_rule"),
        "confidence",
    )
