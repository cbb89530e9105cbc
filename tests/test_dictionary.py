import hashlib

import pytest
from pyspark.sql import functions as F

from tillroll.operators import dictionary as dic
from tillroll.operators import digests, profile


def groups(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "group_key string")


def test_ids_follow_utf16_order(spark):
    keys = ["2", "10", "\U0001f600", "￮", "b", "B", "é"]
    got = [r.group_key for r in dic.build_dictionary(groups(spark, keys)).orderBy("id").collect()]
    assert got == sorted(keys, key=lambda k: k.encode("utf-16-be"))
    assert got.index("\U0001f600") < got.index("￮")


def test_guard(spark):
    with pytest.raises(Exception, match="More than 2 groups"):
        dic.build_dictionary(groups(spark, "abc"), max_keys=2).collect()
    assert dic.build_dictionary(groups(spark, "abc"), max_keys=3).count() == 3
    with pytest.raises(ValueError):
        dic.build_dictionary(groups(spark, "a"), max_keys=0)


def test_ids_over_many_ranges(spark):
    keys = [str(i * 7919 % 100_003) for i in range(5000)]
    spread = groups(spark, keys).repartition(7)
    got = [(r.id, r.group_key) for r in dic.build_dictionary(spread).orderBy("id").collect()]
    assert got == list(enumerate(sorted(keys)))
    assert dic.build_dictionary(groups(spark, [])).count() == 0


def test_checksum(spark):
    # A published dictionary of the identifiers 0 to 31.
    fingerprint = "b9b93dd70a65f2831506f6407365b5f60711005ee594f0f566d1d7f1068599f3"
    checksum = "173faac15a24d8d274d7954eb6bd495008235df5112b32090ae4dcc013e76c4c"
    built = dic.build_dictionary(groups(spark, map(str, range(32))))
    row = dic.dictionary_checksum(built, F.lit(fingerprint), "category_id").first()
    assert (row.checksum, row.groups) == (checksum, 32)


def test_checksum_counts_utf16_units(spark):
    built = dic.build_dictionary(groups(spark, ["\U0001f600"]))
    row = dic.dictionary_checksum(built, F.lit("f"), "category_code").first()
    text = f"1|f|CATEGORY_CODE|{row.policy_hash}\n2:\U0001f600"
    assert row.checksum == hashlib.sha256(text.encode()).hexdigest()


def test_digest_of_ranges(spark):
    built = dic.build_dictionary(groups(spark, [f"key {i}" for i in range(9000)]))

    def digest(frame, mode="category_id"):
        return dic.dictionary_digest(frame, F.lit("f"), mode).first()

    whole = digest(built)
    assert whole.groups == 9000 and digest(built.repartition(3)).digest == whole.digest
    swapped = built.withColumn("group_key", F.when(F.col("id") == 5000, "x").otherwise(F.col("group_key")))
    for other in (swapped, built.where("id < 8999"), built.unionAll(built.limit(1)), groups(spark, []).select(F.lit(0).alias("id"), "group_key")):
        assert digest(other).digest != whole.digest
    assert digest(built, "category_code").digest != whole.digest
    drift = digests.tree_drift(dic.dictionary_tree(built), dic.dictionary_tree(swapped), dic.RANGES).collect()
    assert [(r.first_byte, r.change) for r in drift] == [(4096, "content")]


def test_rows_of_too_many_groups_fail_before_a_shuffle(spark):
    rows = spark.range(1000).selectExpr("CAST(id AS STRING) AS group_key", "1L AS price_minor")
    with pytest.raises(Exception, match="More than 10 groups"):
        dic.guard_rows(rows, 10).write.format("noop").mode("overwrite").save()  # no shuffle in this plan
    kept = dic.guard_rows(rows.select("price_minor", F.lit(None).cast("string").alias("group_key")), 1)
    assert kept.columns == ["price_minor", "group_key"] and kept.count() == 1000
    few = rows.withColumn("group_key", F.expr("CAST(price_minor + CAST(group_key AS BIGINT) % 7 AS STRING)"))
    assert profile.group_counts(few, 7).count() == 7
    with pytest.raises(Exception, match="More than 6 groups"):
        profile.group_counts(few, 6).collect()
    # Each task meets few of them; together they are too many, which the count after the grouping tells.
    spread = rows.repartitionByRange(8, "group_key")
    with pytest.raises(dic.TooManyGroups, match="More than 500 groups: 1000"):
        profile.group_counts(spread, 500).collect()


def test_violations(spark):
    entries = [(0, "a"), (1, "a"), (2, ""), (3, "b\tc"), (4, "z" * 257), (5, "b"), (6, None)]
    damaged = spark.createDataFrame(entries, "id int, group_key string")
    got = sorted((r.id, r.rule) for r in dic.dictionary_violations(damaged).collect())
    assert got == [
        (1, "not_ascending"), (2, "empty_key"), (2, "not_ascending"), (3, "unsafe_character"), (4, "key_too_long"),
        (5, "not_ascending"), (6, "empty_key"),
    ]
