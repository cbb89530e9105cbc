"""The registered queries again as plain SQL over the source tables, for checking results.

Each statement starts from the tables and states what the answer is by the rules, so it shares no
step with the Spark code. Faults are known by their place, not found by parsing.
"""

from __future__ import annotations

RAW = """
raw AS (
  SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S UTC') AS event_time,
         event_type, user_id, json_extract_string(props, '$.k') AS category_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS price_text,
         CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT) AS minor
  FROM events),
clean AS (
  SELECT *, CASE WHEN k % 10 = 0 THEN '' WHEN k % 10 = 1 THEN 'd' || (k % 7)
                 ELSE 'd' || (k % 7) || '.c' || k END AS category_code
  FROM raw)"""

DIRTY = (
    RAW
    + """,
dirty AS (
  SELECT event_id, day, event_time, event_type, user_id, minor,
         CASE WHEN event_id % 499 = 0 THEN 'HEADER' WHEN event_id % 503 = 0 THEN 'MALFORMED' ELSE 'EVENT' END AS kind,
         CASE WHEN event_id % 89 = 0 THEN '' ELSE category_id END AS category_id,
         CASE WHEN event_id % 79 = 0 THEN '.x' ELSE category_code END AS category_code,
         CASE WHEN event_id % 97 = 0 THEN 'NaN' WHEN event_id % 101 = 0 THEN '12.301'
              WHEN event_id % 83 = 0 THEN '-1' ELSE price_text END AS price_text,
         event_id % 97 = 0 OR event_id % 101 = 0 OR event_id % 83 = 0 AS bad_price
  FROM clean)"""
)

KEYS = {
    "id": ("category_id", "event_id % 89 = 0"),
    "code": ("CASE WHEN category_code = '' THEN '__UNKNOWN__' ELSE category_code END", "FALSE"),
    "root": (
        "CASE WHEN category_code = '' THEN '__UNKNOWN__' ELSE split_part(category_code, '.', 1) END",
        "event_id % 79 = 0",
    ),
}


def judged(mode: str) -> str:
    """CTEs up to ``judged`` and ``valid``: dirty events with their outcome, and the valid purchases."""
    key, bad_group = KEYS[mode]
    return f"""{DIRTY},
judged AS (
  SELECT *, {key} AS group_key,
         CASE WHEN kind = 'HEADER' THEN 'HEADER'
              WHEN kind = 'MALFORMED' THEN 'MALFORMED_CSV'
              WHEN event_type IN ('view', 'cart', 'remove_from_cart') THEN 'NON_PURCHASE'
              WHEN event_type <> 'purchase' THEN 'UNKNOWN_EVENT'
              WHEN bad_price THEN 'INVALID_PRICE'
              WHEN {bad_group} THEN 'INVALID_GROUP'
              ELSE 'VALID_PURCHASE' END AS reason
  FROM dirty),
valid AS (SELECT * FROM judged WHERE reason = 'VALID_PURCHASE')"""


def text2(minor: str) -> str:
    return f"printf('%d.%02d', ({minor}) // 100, ({minor}) % 100)"


def half_up(total: str, count: str) -> str:
    return f"CAST((2 * CAST({total} AS HUGEINT) + {count}) // (2 * {count}) AS BIGINT)"


def rollup(ctes: str, source: str, key: str = "group_key", minor: str = "minor") -> str:
    with_clause = f"{ctes},\n" if ctes else ""
    return f"""WITH {with_clause}states AS (
  SELECT {key} AS group_key, CAST(SUM({minor}) AS BIGINT) AS sum_minor, COUNT(*) AS purchase_count
  FROM {source} GROUP BY 1)
SELECT group_key, sum_minor, purchase_count, {text2("sum_minor")} AS total_revenue,
       {text2(half_up("sum_minor", "purchase_count"))} AS average_revenue
FROM states"""


CENTS = "CAST(CAST({} AS DECIMAL(18,2)) * 100 AS BIGINT)"
ORDERS = f"""orders_minor AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer, o_orderpriority AS priority,
         {CENTS.format("o_totalprice")} AS minor FROM orders)"""
ORDER_STATES = f"""{ORDERS},
order_states AS (
  SELECT customer AS group_key, CAST(SUM(minor) AS BIGINT) AS sum_minor, COUNT(*) AS purchase_count
  FROM orders_minor GROUP BY 1)"""

LINES = (
    DIRTY
    + """,
lines AS (
  SELECT event_id, day, kind,
         CASE WHEN kind = 'HEADER' THEN 'event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session'
              ELSE event_time || ',' || event_type || ',' || event_id || ',' || category_id || ',' || category_code || ',' ||
                   CASE WHEN event_id % 7 = 0 THEN '"say ""hi"", twice"' ELSE 'brand' END || ',' || price_text || ',' ||
                   user_id || CASE WHEN kind = 'EVENT' THEN ',' ELSE '' END
         END || CASE WHEN event_id % 11 = 0 THEN chr(13) ELSE '' END AS value
  FROM dirty)"""
)

PARSED = f"""WITH {DIRTY}
SELECT event_id AS "offset", kind,
       CASE WHEN kind = 'EVENT' THEN event_type END AS event_type,
       CASE WHEN kind = 'EVENT' THEN category_id END AS category_id,
       CASE WHEN kind = 'EVENT' THEN category_code END AS category_code,
       CASE WHEN kind = 'EVENT' THEN price_text END AS price_text
FROM dirty"""


def dictionary(mode: str) -> str:
    return f"""{judged(mode)},
dictionary AS (
  SELECT row_number() OVER (ORDER BY group_key) - 1 AS id, group_key
  FROM (SELECT DISTINCT group_key FROM valid))"""


PACKED = f"""{dictionary("id")},
entries AS (
  SELECT v.day, d.id // 32 AS bucket, d.id, CAST(SUM(v.minor) AS BIGINT) AS sum_minor,
         COUNT(*) AS purchase_count
  FROM valid v JOIN dictionary d USING (group_key) GROUP BY v.day, d.id)"""


def cell(value: str) -> str:
    return f"coalesce(length(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


# What a day's digest covers: each column of the nine an event has, and its kind, number and day.
ROW_TEXT = " || ';' || ".join(
    map(
        cell,
        (
            "kind",
            "event_id",
            "day",
            "event_time",
            "event_type",
            "event_id",
            "category_id",
            "category_code",
            "'brand'",
            "price_text",
            "user_id",
            "''",
        ),
    )
)


WORD_SUMS = ", ".join(f"SUM(('0x' || substr(hash, {1 + 8 * i}, 8))::HUGEINT) AS w{i}" for i in range(8))
#: Sums modulo 2 ** 64, as one text.
WORDS_TEXT = " || ':' || ".join(f"(w{i} % 18446744073709551616)" for i in range(8))


def summed_digest(name: str, source: str) -> str:
    """CTEs ending in ``name``: one digest per ``uri`` over the ``place, value`` of the rows of ``source``."""
    return f"""{name}_hashed AS (SELECT uri, value, sha256(place || ':' || value) AS hash FROM {source}),
{name}_words AS (
  SELECT uri, CAST(SUM(strlen(value) + 1) AS BIGINT) AS bytes, COUNT(*) AS lines, {WORD_SUMS} FROM {name}_hashed GROUP BY uri),
{name} AS (SELECT uri, bytes, sha256(lines || ':' || {WORDS_TEXT}) AS sha256 FROM {name}_words)"""


def placed(source: str, kind: str) -> str:
    return f"(SELECT day AS uri, event_id AS place, {ROW_TEXT.replace('kind', kind)} AS value FROM {source})"


def manifest(name: str, source: str, kind: str) -> str:
    """CTEs ending in ``name``: one digest per day over position and content of the day's events."""
    return summed_digest(name, placed(source, kind))


def block_tree(name: str, source: str, block: int, fanout: int, height: int) -> str:
    """CTEs ending in ``name``: the nodes of the tree over blocks of ``uri, place, value``."""
    levels = [
        f"""{name}_0 AS (
  SELECT uri, 0 AS level, node, first_byte, last_byte, lines, sha256(lines || ':' || {WORDS_TEXT}) AS sha256
  FROM (SELECT uri, place // {block} AS node, MIN(place) AS first_byte, MAX(place + strlen(value)) AS last_byte,
               COUNT(*) AS lines, {WORD_SUMS}
        FROM (SELECT *, sha256(place || ':' || value) AS hash FROM {source}) GROUP BY ALL))"""
    ]
    for level in range(1, height + 1):
        levels.append(
            f"""{name}_{level} AS (
  SELECT uri, {level} AS level, node // {fanout} AS node, MIN(first_byte) AS first_byte, MAX(last_byte) AS last_byte,
         CAST(SUM(lines) AS BIGINT) AS lines, sha256(string_agg(node || ':' || sha256, chr(10) ORDER BY node)) AS sha256
  FROM {name}_{level - 1} GROUP BY uri, node // {fanout})"""
        )
    union = " UNION ALL ".join(f"SELECT * FROM {name}_{level}" for level in range(height + 1))
    return ", ".join([*levels, f"{name} AS ({union})"])


POLICY_HASH = "e8cfaa885aa0cabdc51d54c4ee15e5c7a82b70c3cb69406582ed58c47ed2e117"
CLEAN_MANIFEST = manifest("clean_manifest", "clean", "'EVENT'")
DIRTY_MANIFEST = manifest("dirty_manifest", "dirty", "kind")


def fingerprint(source: str) -> str:
    return f"""SELECT sha256('{POLICY_HASH}' || chr(10) ||
         string_agg(uri || chr(9) || bytes || chr(9) || sha256 || chr(10), '' ORDER BY uri)) AS input_fingerprint,
       COUNT(*) AS files FROM {source}"""


STATISTICS = f"""{judged("code")},
placed AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY event_id) AS position FROM judged),
statistics AS (
  SELECT 'events/day=' || day AS uri, COUNT(*) AS lines,
         COUNT(*) FILTER (WHERE reason = 'VALID_PURCHASE') AS valid_purchases,
         CAST(0 AS BIGINT) AS invalid_utf8, CAST(0 AS BIGINT) AS line_too_long,
         COUNT(*) FILTER (WHERE kind = 'MALFORMED') AS malformed_line,
         CAST(0 AS BIGINT) AS group_field_too_long,
         bool_or(position = 1 AND kind = 'HEADER') AS has_header
  FROM placed GROUP BY day),
rules AS (
  SELECT uri, 'malformed_line' AS rule, malformed_line AS n FROM statistics WHERE malformed_line > 0
  UNION ALL SELECT uri, 'missing_header', 1 FROM statistics WHERE NOT has_header
  UNION ALL SELECT uri, 'no_header', 1 FROM statistics WHERE NOT has_header)"""


DAMAGED_LINES = f"""{RAW},
damaged AS (
  SELECT 'events/day=' || day AS uri, event_id + 1 AS "offset",
         CASE WHEN event_id % 211 = 0 THEN 'line_too_long' WHEN event_id % 223 = 0 THEN 'invalid_utf8'
              WHEN event_id % 227 = 0 THEN 'malformed_line' WHEN event_id % 229 = 0 THEN 'group_field_too_long' END AS rule
  FROM clean)"""


def bucket(uri: str, seed: int, offset: str, buckets: int) -> str:
    head = (
        f"('0x' || substr(sha256(encode('{uri}') || unhex('00') || unhex(printf('%016x', {seed})) || "
        f"unhex(printf('%016x', {offset}))), 1, 8))::BIGINT"
    )
    return (
        f"((({head} - CASE WHEN {head} >= 2147483648 THEN 4294967296 ELSE 0 END) % {buckets}) + {buckets}) % {buckets}"
    )


SAMPLED = f"""sampled AS (
  SELECT event_id, event_type FROM events WHERE {bucket("table:events", 21, "event_id", 1000000)} < 250000)"""


def draw(purpose: str) -> str:
    return f"(('0x' || substr(sha256('21:{purpose}:' || o_orderkey), 1, 12))::BIGINT / 281474976710656.0)"


def synthetic(group: str, rate: float) -> str:
    return f"""drawn AS (
  SELECT CAST({group} AS BIGINT) AS grp, CAST(floor({draw("price")} * 5001) AS BIGINT) AS minor
  FROM orders WHERE {draw("type")} < {rate})"""


RECORDS = """records AS (
  SELECT 'v' || (user_id % 5 + 1) AS variant, event_type <> 'error' AS success, event_type = 'signup' AS warmup,
         CAST(round(value * 100) AS BIGINT) AS job_ms, user_id, event_id
  FROM events),
measured AS (
  SELECT variant, upper(variant) AS effective_variant, job_ms, job_ms + user_id AS end_to_end_ms,
         CASE variant WHEN 'v5' THEN NULL WHEN 'v4' THEN 1085 ELSE 0 END AS profile_ms,
         event_id * 10 AS shuffle_bytes, event_id AS map_records,
         CASE WHEN variant <> 'v2' THEN user_id END AS reduce_records
  FROM records WHERE success AND NOT warmup),
summed AS (
  SELECT variant, string_agg(DISTINCT effective_variant, ',') AS effective_variant, COUNT(*) AS runs,
         median(job_ms) AS job_median_ms, MIN(job_ms) AS job_min_ms, MAX(job_ms) AS job_max_ms,
         median(end_to_end_ms) AS end_to_end_median_ms,
         CASE WHEN COUNT(profile_ms) = COUNT(*) THEN median(end_to_end_ms + profile_ms) END AS with_profile_median_ms,
         median(shuffle_bytes) AS shuffle_median_bytes, median(map_records) AS map_output_median_records,
         CASE WHEN COUNT(reduce_records) = COUNT(*) THEN median(reduce_records) END AS reduce_input_median_records
  FROM measured GROUP BY variant)"""

DAMAGED_RESULT = f"""{ORDER_STATES},
numbered AS (SELECT *, CAST(group_key AS BIGINT) AS c, CASE WHEN CAST(group_key AS BIGINT) % 13 = 0 THEN 2 ELSE 1 END AS copies
             FROM order_states),
ruled AS (
  SELECT c, copies,
         CASE WHEN c % 17 = 0 THEN 'average' WHEN c % 19 = 0 THEN 'total' WHEN c % 23 = 0 THEN 'count'
              WHEN c % 29 = 0 THEN 'columns' WHEN c % 31 = 0 THEN 'empty_key' END AS violation
  FROM numbered),
found AS (
  SELECT violation, CASE WHEN violation IN ('columns', 'empty_key') THEN -1 ELSE c END AS owner, SUM(copies) AS n
  FROM ruled WHERE violation IS NOT NULL GROUP BY 1, 2
  UNION ALL SELECT 'duplicate_key', c, 2 FROM ruled WHERE violation IS NULL AND copies = 2)"""

STATES_BY_DAY = f"""{judged("code")},
daily AS (
  SELECT day, group_key, CAST(SUM(minor) AS BIGINT) AS sum_minor, COUNT(*) AS purchase_count
  FROM valid GROUP BY day, group_key)"""

ID_RESULT = rollup(judged("id"), "valid")

ORACLES: dict[str, str] = {
    "purchase_value_by_category_id": rollup(RAW, "clean WHERE event_type = 'purchase'", "category_id"),
    "purchase_value_by_category_code": rollup(judged("code"), "valid"),
    "incremental_rollup": rollup(judged("code"), "valid"),
    "purchase_value_by_category_root": rollup(judged("root"), "valid"),
    "order_value_by_customer": rollup(ORDERS, "orders_minor", "customer"),
    "order_value_by_priority": rollup(ORDERS, "orders_minor", "split_part(priority, '.', 1)"),
    "line_value_by_part": rollup("", "lineitem", "CAST(l_partkey AS VARCHAR)", CENTS.format("l_extendedprice")),
    "line_value_by_brand": rollup(
        "", "lineitem JOIN part ON l_partkey = p_partkey", "p_brand", CENTS.format("l_extendedprice")
    ),
    "event_reason_counts": f"WITH {judged('id')} SELECT reason, COUNT(*) AS n FROM judged GROUP BY reason",
    "event_reason_counts_by_root": f"WITH {judged('root')} SELECT reason, COUNT(*) AS n FROM judged GROUP BY reason",
    "missing_code_count": f"WITH {judged('code')} SELECT COUNT(*) AS missing_code FROM valid WHERE category_code = ''",
    "prepared_purchases": f"""WITH {judged("code")}
SELECT event_id, reason, CASE WHEN reason = 'VALID_PURCHASE' THEN group_key END AS group_key,
       CASE WHEN reason = 'VALID_PURCHASE' THEN minor END AS price_minor,
       reason = 'VALID_PURCHASE' AND category_code = '' AS missing_code
FROM judged""",
    "event_tally": f"""WITH {judged("code")}
SELECT reason, CASE WHEN reason = 'VALID_PURCHASE' THEN group_key END AS group_key, COUNT(*) AS n,
       CAST(SUM(CASE WHEN reason = 'VALID_PURCHASE' THEN minor END) AS BIGINT) AS sum_minor,
       COUNT(*) FILTER (WHERE reason = 'VALID_PURCHASE' AND category_code = '') AS missing_code
FROM judged GROUP BY 1, 2""",
    "money_parse": """WITH c AS (SELECT event_id, CAST(round(value * 100) AS BIGINT) AS cents, event_id % 12 AS spelling FROM events)
SELECT event_id,
       CASE WHEN spelling <= 4 THEN cents WHEN spelling = 5 THEN cents * 100
            WHEN spelling IN (8, 10) AND cents = 0 THEN 0 WHEN spelling = 11 THEN 0 END AS price_minor
FROM c""",
    "money_average": f"""WITH s AS (
  SELECT user_id, CAST(SUM({CENTS.format("value")}) AS BIGINT) AS total, COUNT(*) AS n FROM events GROUP BY user_id)
SELECT user_id, {text2("total")} AS total_text, {text2(half_up("total", "n"))} AS average_text FROM s""",
    "sample_buckets": f"""SELECT event_id, CAST({bucket("table:events", -21, "event_id", 1000)} AS INTEGER) AS bucket FROM events""",
    "parsed_event_lines": PARSED,
    "projected_event_lines": PARSED,
    "line_value_by_category_code": rollup(judged("code"), "valid"),
    "strategy_direct": ID_RESULT,
    "strategy_partial": ID_RESULT,
    "strategy_dictionary": ID_RESULT,
    "strategy_packed": ID_RESULT,
    "packed_entries": f"WITH {PACKED} SELECT day, bucket, id, sum_minor, purchase_count FROM entries",
    "packed_bucket_sizes": f"""WITH {PACKED}
SELECT day, bucket, CAST(COUNT(*) AS INTEGER) AS entries FROM entries GROUP BY day, bucket""",
    "partial_states_by_day": f"WITH {STATES_BY_DAY} SELECT * FROM daily",
    "merged_states": f"""WITH {judged("code")}
SELECT group_key, CAST(SUM(minor) AS BIGINT) AS sum_minor, COUNT(*) AS purchase_count FROM valid GROUP BY group_key""",
    "group_dictionary": f"WITH {dictionary('code')} SELECT id, group_key FROM dictionary",
    "dictionary_misses": f"""WITH {judged("code")}
SELECT group_key, COUNT(*) AS purchase_count FROM valid
WHERE group_key NOT IN (
  SELECT CASE WHEN category_code = '' THEN '__UNKNOWN__' ELSE split_part(category_code, '.', 1) END
  FROM valid WHERE event_id % 79 <> 0)
GROUP BY group_key""",
    "profile_group_counts": f"""WITH {judged("root")}
SELECT group_key, COUNT(*) AS purchase_count FROM valid GROUP BY group_key""",
    "result_totals": f"""WITH {judged("id")}
SELECT COUNT(DISTINCT group_key) AS group_count, COUNT(*) AS total_count, CAST(SUM(minor) AS BIGINT) AS total_sum_minor
FROM valid""",
    "record_reduction": f"""WITH {PACKED}
SELECT 'direct' AS strategy, CAST(SUM(purchase_count) AS BIGINT) AS records FROM entries
UNION ALL SELECT 'partial', COUNT(*) FROM entries
UNION ALL SELECT 'dictionary', COUNT(*) FROM entries
UNION ALL SELECT 'packed', COUNT(*) FROM (SELECT DISTINCT day, bucket FROM entries)""",
    "hash_sample": f"WITH {SAMPLED} SELECT event_id, event_type FROM sampled",
    "hash_sample_type_shares": f"WITH {SAMPLED} SELECT event_type, COUNT(*) AS n FROM sampled GROUP BY event_type",
    "result_violations": f"""WITH {DAMAGED_RESULT}
SELECT violation, COUNT(*) AS groups, CAST(SUM(n) AS BIGINT) AS lines FROM found GROUP BY violation""",
    "validated_result": f"""WITH {ORDER_STATES}
SELECT COUNT(*) AS group_count, CAST(SUM(purchase_count) AS BIGINT) AS total_count,
       CAST(SUM(sum_minor) AS BIGINT) AS total_sum_minor, CAST(0 AS BIGINT) AS violations, FALSE AS too_many_groups,
       SUM(purchase_count) = (SELECT COUNT(*) FROM orders) AS valid
FROM order_states""",
    "rejected_result": "SELECT COUNT(DISTINCT o_custkey) > 10 AS too_many_groups, FALSE AS valid FROM orders",
    "duplicate_keys": """SELECT CAST(o_custkey AS VARCHAR) AS category_id, o_orderpriority || '.' || o_orderstatus AS category_code,
       COUNT(*) AS n FROM orders GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "result_diff": f"""WITH {judged("code")},
l AS (SELECT CASE WHEN category_code = '' THEN '__UNKNOWN__' ELSE category_code END AS group_key,
             CAST(SUM(minor) AS BIGINT) AS left_sum, COUNT(*) AS left_count
      FROM clean WHERE event_type = 'purchase' GROUP BY 1),
r AS (SELECT group_key, CAST(SUM(minor) AS BIGINT) AS right_sum, COUNT(*) AS right_count FROM valid GROUP BY 1)
SELECT group_key, left_sum, left_count, right_sum, right_count,
       CASE WHEN right_count IS NULL THEN 'only_left' WHEN left_count IS NULL THEN 'only_right' ELSE 'differs' END AS difference
FROM l FULL JOIN r USING (group_key)
WHERE left_sum IS DISTINCT FROM right_sum OR left_count IS DISTINCT FROM right_count""",
    "slice_manifest": f"WITH {DIRTY}, {DIRTY_MANIFEST} SELECT uri, bytes, sha256 FROM dirty_manifest",
    "input_drift": f"""WITH {DIRTY}, {CLEAN_MANIFEST}, {DIRTY_MANIFEST}
SELECT uri, CASE WHEN d.sha256 IS NULL THEN 'missing' WHEN c.sha256 IS NULL THEN 'added'
                 WHEN c.bytes <> d.bytes THEN 'bytes' ELSE 'content' END AS change
FROM clean_manifest c FULL JOIN dirty_manifest d USING (uri)
WHERE c.bytes IS DISTINCT FROM d.bytes OR c.sha256 IS DISTINCT FROM d.sha256""",
    "repeated_line_drift": f"""WITH {DIRTY},
swapped AS (
  SELECT side, day AS uri, 0 AS place, {ROW_TEXT.replace("kind", "'EVENT'")} AS value
  FROM (SELECT *, unnest([0, 1]) AS side FROM clean), (SELECT unnest([1, 2]) AS copy)
  WHERE CASE event_id % 4 WHEN 0 THEN side = 0 OR right(day, 2)::INT % 2 = 1 WHEN 1 THEN side = 1 AND right(day, 2)::INT % 2 = 0 ELSE copy = 1 END),
l AS (SELECT uri, place, value FROM swapped WHERE side = 0), r AS (SELECT uri, place, value FROM swapped WHERE side = 1),
{summed_digest("left_digest", "l")}, {summed_digest("right_digest", "r")}
SELECT uri, CASE WHEN d.sha256 IS NULL THEN 'missing' WHEN c.sha256 IS NULL THEN 'added'
                 WHEN c.bytes <> d.bytes THEN 'bytes' ELSE 'content' END AS change
FROM left_digest c FULL JOIN right_digest d USING (uri)
WHERE c.bytes IS DISTINCT FROM d.bytes OR c.sha256 IS DISTINCT FROM d.sha256""",
    "block_manifest": f"""WITH {DIRTY}, {block_tree("dirty_tree", placed("dirty", "kind"), 256, 8, 4)}
SELECT uri, level, node, first_byte, last_byte, lines, sha256 FROM dirty_tree""",
    "block_drift": f"""WITH {DIRTY}, {block_tree("clean_tree", placed("clean", "'EVENT'"), 256, 8, 4)},
{block_tree("dirty_tree", placed("dirty", "kind"), 256, 8, 4)}
SELECT uri, least(c.first_byte, d.first_byte) AS first_byte, greatest(c.last_byte, d.last_byte) AS last_byte,
       CASE WHEN d.sha256 IS NULL THEN 'missing' WHEN c.sha256 IS NULL THEN 'added' ELSE 'content' END AS change
FROM (SELECT * FROM clean_tree WHERE level = 0) c FULL JOIN (SELECT * FROM dirty_tree WHERE level = 0) d USING (uri, node)
WHERE c.sha256 IS DISTINCT FROM d.sha256""",
    "manifest_fingerprint": f"""WITH {DIRTY}, {DIRTY_MANIFEST}, f AS ({fingerprint("dirty_manifest")})
SELECT input_fingerprint, '{POLICY_HASH}' AS policy_hash, CAST(1 AS INTEGER) AS schema_version, files FROM f""",
    "provenance_match": f"""WITH {DIRTY}, {CLEAN_MANIFEST}, {DIRTY_MANIFEST},
l AS ({fingerprint("clean_manifest")}), r AS ({fingerprint("dirty_manifest")})
SELECT 'input_fingerprint' AS field, l.input_fingerprint AS left_value, r.input_fingerprint AS right_value,
       l.input_fingerprint = r.input_fingerprint AS equal FROM l, r
UNION ALL SELECT 'policy_hash', '{POLICY_HASH}', '{POLICY_HASH}', TRUE
UNION ALL SELECT 'schema_version', '1', '1', TRUE""",
    "dictionary_checksum": f"""WITH {dictionary("code")}
SELECT 'events' AS input_fingerprint, 'CATEGORY_CODE' AS group_mode, '{POLICY_HASH}' AS policy_hash,
       CAST(COUNT(*) AS INTEGER) AS groups,
       sha256('1|events|CATEGORY_CODE|{POLICY_HASH}' ||
              string_agg(chr(10) || length(group_key) || ':' || group_key, '' ORDER BY id)) AS checksum
FROM dictionary""",
    "dictionary_digest": f"""WITH {dictionary("code")},
entries AS (SELECT 'dictionary' AS uri, id AS place, group_key AS value FROM dictionary),
{summed_digest("whole", "entries")},
head AS (SELECT (SELECT COUNT(*) FROM dictionary) AS groups, sha256 AS root FROM whole)
SELECT 'events' AS input_fingerprint, 'CATEGORY_CODE' AS group_mode, '{POLICY_HASH}' AS policy_hash, groups,
       sha256('events|CATEGORY_CODE|{POLICY_HASH}|' || groups || '|' || root) AS digest FROM head""",
    "dictionary_ranges": f"""WITH {dictionary("code")},
entries AS (SELECT 'dictionary' AS uri, id AS place, group_key AS value FROM dictionary),
{block_tree("ranges", "entries", 8, 4, 5)}
SELECT uri, level, node, first_byte, last_byte, lines, sha256 FROM ranges""",
    "dictionary_violations": f"""WITH {dictionary("code")},
damaged AS (
  SELECT id, CASE WHEN id % 10 = 3 THEN group_key || chr(9) || 'x' WHEN id % 10 = 5 THEN rpad(group_key, 300, 'z')
                  WHEN id % 10 = 7 THEN 'd0' WHEN id % 10 = 9 THEN '' ELSE group_key END AS key FROM dictionary),
paired AS (SELECT id, key, lag(key) OVER (ORDER BY id) AS previous FROM damaged)
SELECT id, 'empty_key' AS rule FROM paired WHERE key = ''
UNION ALL SELECT id, 'key_too_long' FROM paired WHERE strlen(key) > 256
UNION ALL SELECT id, 'unsafe_character' FROM paired WHERE contains(key, chr(9))
UNION ALL SELECT id, 'not_ascending' FROM paired WHERE previous >= key""",
    "state_violations": f"""WITH {STATES_BY_DAY},
damaged AS (
  SELECT day, group_key, sum_minor - 1000 AS sum_minor,
         CASE purchase_count WHEN 1 THEN 0 WHEN 2 THEN -2 ELSE purchase_count END AS purchase_count FROM daily),
ruled AS (
  SELECT *, CASE WHEN sum_minor < 0 THEN 'negative_sum' WHEN purchase_count < 0 THEN 'negative_count'
                 WHEN purchase_count = 0 AND sum_minor <> 0 THEN 'sum_without_count' END AS rule FROM damaged)
SELECT day, group_key, sum_minor, CAST(purchase_count AS BIGINT) AS purchase_count, rule FROM ruled WHERE rule IS NOT NULL""",
    "packed_violations": f"""WITH {PACKED}
SELECT day, bucket, 'invalid_entry' AS rule, COUNT(*) AS n FROM entries WHERE purchase_count = 1 GROUP BY day, bucket
UNION ALL
SELECT day, bucket, 'batch_too_long', 1 FROM entries GROUP BY day, bucket HAVING COUNT(*) > 30""",
    "preflight_file_statistics": f"WITH {STATISTICS} SELECT * FROM statistics",
    "preflight_rule_counts": f"WITH {STATISTICS} SELECT uri, rule, CAST(n AS BIGINT) AS n FROM rules",
    "preflight_totals": f"""WITH {STATISTICS}
SELECT COUNT(*) AS files, CAST(SUM(lines) AS BIGINT) AS lines, CAST(SUM(valid_purchases) AS BIGINT) AS valid_purchases,
       CAST((SELECT SUM(n) FROM rules) AS BIGINT) AS errors
FROM statistics""",
    "preflight_first_errors": f"""WITH {DIRTY}
SELECT 'events/day=' || day AS uri, event_id AS "offset", 'malformed_line' AS rule
FROM dirty WHERE kind = 'MALFORMED' ORDER BY uri, "offset" LIMIT 20""",
    "damaged_line_rules": f"WITH {DAMAGED_LINES} SELECT rule, COUNT(*) AS n FROM damaged WHERE rule IS NOT NULL GROUP BY rule",
    "damaged_first_errors": f"""WITH {DAMAGED_LINES}
SELECT uri, "offset", rule FROM damaged WHERE rule IS NOT NULL ORDER BY uri, "offset" LIMIT 20""",
    "reconciliation": f"""WITH {judged("code")}, n AS (SELECT COUNT(*) AS n FROM valid)
SELECT n AS counted, n AS preflighted, n AS in_result, TRUE AS reconciled FROM n""",
    "result_roundtrip": f"""WITH {ORDER_STATES}
SELECT group_key, sum_minor, purchase_count, {text2("sum_minor")} AS total_revenue,
       {text2(half_up("sum_minor", "purchase_count"))} AS average_revenue FROM order_states""",
    "export_sorted": f"""WITH result AS ({rollup(judged("code"), "valid")})
SELECT CAST(0 AS BIGINT) AS position, 'group_key,total_revenue,purchase_count,average_revenue' AS value
UNION ALL
SELECT row_number() OVER (ORDER BY group_key), group_key || ',' || total_revenue || ',' || purchase_count || ',' || average_revenue
FROM result""",
    "csv_file_offsets": f"""WITH {LINES}
SELECT kind, COUNT(*) AS n, CAST(SUM(strlen(value) + 1) AS BIGINT) AS bytes, CAST(0 AS BIGINT) AS gaps
FROM lines WHERE kind <> 'HEADER' GROUP BY kind""",
    "stored_manifest": f"""WITH {LINES}
SELECT CAST(SUM(strlen(value) + 1) AS BIGINT) AS bytes, CAST(0 AS BIGINT) AS strays, CAST(0 AS BIGINT) AS drifted FROM lines""",
    "run_records": f"""WITH {judged("id")},
counted AS (SELECT COUNT(*) AS purchases, COUNT(DISTINCT group_key) AS groups, CAST(SUM(minor) AS BIGINT) AS total_sum_minor FROM valid),
broken AS (SELECT COUNT(*) AS malformed FROM judged WHERE reason = 'MALFORMED_CSV'),
routes AS (SELECT * FROM (VALUES ('v2', 'partial'), ('v4', 'dictionary'), ('v5', 'packed')) AS t(variant, effective_variant))
SELECT variant, effective_variant, TRUE AS success, purchases, CAST(NULL AS BIGINT) AS malformed, groups, total_sum_minor,
       FALSE AS has_error, effective_variant <> 'partial' AS profiled
FROM routes, counted
UNION ALL
SELECT 'v1', 'partial', FALSE, purchases, malformed, NULL, NULL, TRUE, FALSE FROM counted, broken""",
    "synthetic_skew": rollup(
        synthetic(f"CASE WHEN {draw('skew')} < 0.9 THEN 0 ELSE floor({draw('group')} * 32) END", 0.5),
        "drawn",
        "'synthetic.category' || grp",
    ),
    "synthetic_uniform": rollup(synthetic(f"floor({draw('group')} * 100)", 0.2), "drawn", "CAST(grp AS VARCHAR)"),
    "synthetic_cardinality": f"""WITH {synthetic("o_orderkey", 1.0)}
SELECT CAST(grp AS VARCHAR) AS group_key, minor AS sum_minor, CAST(1 AS BIGINT) AS purchase_count FROM drawn""",
    "run_summary": f"""WITH {RECORDS}
SELECT *, CASE WHEN job_median_ms <> 0 THEN (SELECT job_median_ms FROM summed WHERE variant = 'v1') / job_median_ms END AS speedup
FROM summed""",
}
