import io
from contextlib import redirect_stdout

import pytest

from tillroll.operators import aggregate as agg
from tillroll.operators import compare, profile
from tillroll.operators import dictionary as dic
from tillroll.operators.prepare import prepare
from tillroll.session import materialize

# A published fixture with its results, kept to hold the numbers against it.
FIXTURE = [
    ("purchase", "1", "electronics.smartphone", "10.00"), ("purchase", "1", "electronics.smartphone", "20.00"),
    ("purchase", "1", "electronics.smartphone", "30.00"), ("view", "1", "electronics.smartphone", "99.00"),
    ("purchase", "2", "", "0.00"), ("purchase", "2", "", "0.01"), ("purchase", "2", "", "0.02"),
]
SCHEMA = "event_type string, category_id string, category_code string, price_text string"
GOLDEN = {
    "category_id": {("1", "60.00", 3, "20.00"), ("2", "0.03", 3, "0.01")},
    "category_code": {("electronics.smartphone", "60.00", 3, "20.00"), ("__UNKNOWN__", "0.03", 3, "0.01")},
    "category_root": {("electronics", "60.00", 3, "20.00"), ("__UNKNOWN__", "0.03", 3, "0.01")},
}


def by_route(prepared, strategy):
    dictionary = materialize(dic.build_dictionary(dic.counted_groups(prepared)))
    return agg.aggregate(prepared, strategy, dictionary)


def rows(df):
    return {(r.group_key, r.total_revenue, r.purchase_count, r.average_revenue) for r in agg.result_rows(df).collect()}


@pytest.mark.parametrize("mode", GOLDEN)
@pytest.mark.parametrize("strategy", ["v1", "v2", "v3", "v4", "v5"])
def test_fixture(spark, mode, strategy):
    prepared = prepare(spark.createDataFrame(FIXTURE, SCHEMA).repartition(3), mode)
    assert rows(by_route(prepared, strategy)) == GOLDEN[mode]


@pytest.mark.parametrize("strategy", agg.STRATEGIES)
def test_no_purchases(spark, strategy):
    prepared = prepare(spark.createDataFrame([("view", "1", "a", "1")], SCHEMA), "category_id")
    assert rows(by_route(prepared, strategy)) == set()


@pytest.mark.parametrize("strategy", agg.STRATEGIES)
def test_hot_key_and_many_keys(spark, strategy):
    events = spark.range(0, 60000, 1, 16).selectExpr(
        "'purchase' AS event_type", "if(id % 3 = 0, '7', CAST(1000 + id % 900 AS STRING)) AS category_id",
        "'' AS category_code", "concat(id % 50, '.25') AS price_text",
    )
    want = {}
    for i in range(60000):
        key = "7" if i % 3 == 0 else str(1000 + i % 900)
        total, n = want.get(key, (0, 0))
        want[key] = (total + (i % 50) * 100 + 25, n + 1)
    got = by_route(prepare(events, "category_id"), strategy).collect()
    assert {r.group_key: (r.sum_minor, r.purchase_count) for r in got} == want
    assert len(got) == len(want)


def test_emitted_records(spark):
    events = spark.range(600).selectExpr(
        "'purchase' AS event_type", "CAST(id % 3 AS STRING) AS category_id", "'' AS category_code", "'1.00' AS price_text", "1 AS slice"
    )
    prepared = prepare(events, "category_id", keep=("slice",))
    dictionary = dic.build_dictionary(dic.counted_groups(prepared))
    packed = agg.pack(prepared, dictionary, "slice", ids=2)
    sizes = profile.state_sizes(agg.partial_states(prepared, "slice"), packed)
    assert {r.strategy: r.records for r in sizes.collect()} == {"direct": 600, "partial": 3, "dictionary": 3, "packed": 2}
    totals = profile.result_totals(agg.partial(prepared)).first()
    assert (totals.group_count, totals.total_count, totals.total_sum_minor) == (3, 600, 60000)


def test_merge_of_flushed_states(spark):
    states = spark.createDataFrame([("A", 1000, 1), ("B", 2000, 1), ("A", 3000, 1), ("C", 0, 0)], "group_key string, sum_minor bigint, purchase_count bigint")
    assert {tuple(r) for r in agg.merge_states(states).collect()} == {("A", 4000, 2), ("B", 2000, 1)}


def test_bad_arguments(spark):
    prepared = prepare(spark.createDataFrame(FIXTURE, SCHEMA), "category_id")
    for strategy in ("packed", "dictionary"):
        with pytest.raises(ValueError, match="needs a dictionary"):
            agg.aggregate(prepared, strategy)
    with pytest.raises(ValueError, match="Unknown strategy"):
        agg.aggregate(prepared, "salted")


@pytest.mark.parametrize("strategy", ["dictionary", "packed"])
def test_unlisted_group_fails(spark, strategy):
    prepared = prepare(spark.createDataFrame(FIXTURE, SCHEMA), "category_id")
    partial_dictionary = spark.createDataFrame([(0, "1")], "id int, group_key string")
    with pytest.raises(Exception, match="Not in the dictionary: 2"):
        agg.aggregate(prepared, strategy, partial_dictionary).collect()
    assert [tuple(r) for r in dic.dictionary_misses(prepared, partial_dictionary).collect()] == [("2", 3)]


def test_stray_packed_entry_fails(spark):
    packed = spark.createDataFrame([(0, [(1, 100, 1)])], "bucket int, entries array<struct<id:int,sum_minor:bigint,purchase_count:bigint>>")
    with pytest.raises(Exception, match="Not an id of the dictionary: 1"):
        agg.merge_packed(packed, spark.createDataFrame([(0, "a")], "id int, group_key string")).collect()
    bad = spark.createDataFrame([(0, [(0, -1, 1), (2, 5, 0), (4, 5, 1)])], packed.schema)
    assert [r.rule for r in compare.packed_violations(bad, max_entries=3).collect()] == ["invalid_entry"] * 2
    assert "batch_too_long" in [r.rule for r in compare.packed_violations(bad, max_entries=2).collect()]


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_plans(spark, static_plans):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr(
        "event_type", "get_json_object(props, '$.k') AS category_id", "'' AS category_code",
        "CAST(CAST(value AS DECIMAL(18,2)) AS STRING) AS price_text",
    )
    from tillroll.operators.prepare import purchases_only

    prepared = prepare(purchases_only(events), "category_id")
    partial = plan_of(agg.partial(prepared))
    assert partial.count("Exchange") == 1
    assert partial.index("partial_try_sum") > partial.index("Exchange") > partial.index("HashAggregate")
    assert "StringContains(event_type,purchase)" in partial
    assert "ReadSchema: struct<event_type:string,value:double,props:string>" in partial
    dictionary = spark.createDataFrame([(0, "1")], "id int, group_key string")
    encoded = plan_of(agg.by_dictionary(prepared, dictionary))
    # Purchases are states before they meet the dictionary.
    first_join, last_aggregate = encoded.rindex("Join"), encoded.index("HashAggregate")
    assert encoded.count("Join") == 2 and "Cartesian" not in encoded and first_join < last_aggregate


def test_state_rules(spark):
    states = spark.createDataFrame([(0, 0), (5, 0), (-1, 2), (3, -1), (1, 1), (None, 1)], "sum_minor bigint, purchase_count bigint")
    got = sorted(r.rule for r in compare.state_violations(states).collect())
    assert got == ["negative_count", "negative_sum", "null_part", "sum_without_count"]


def test_reason_counts_and_missing_codes(spark):
    prepared = prepare(spark.createDataFrame(FIXTURE, SCHEMA), "category_code")
    assert {tuple(r) for r in profile.reason_counts(prepared).collect()} == {("VALID_PURCHASE", 6), ("NON_PURCHASE", 1)}
    assert profile.missing_code_count(prepared).first().missing_code == 3
    assert [tuple(r) for r in profile.group_counts(prepared).collect()] == [("__UNKNOWN__", 3), ("electronics.smartphone", 3)]
    with pytest.raises(Exception, match="More than 1 groups"):
        profile.group_counts(prepared, max_keys=1).collect()
