import random

import pytest

from tillroll.functions.csvline import parse_event_lines
from tillroll.model import EVENT_COLUMNS, HEADER_LINE
from tillroll.operators.prepare import prepare

BLANKS = "".join(map(chr, range(0x21)))
AFTER_QUOTE = " \t\x0b\x0c\x1c\x1d\x1e\x1f  "


def fields_of(line):
    """Character walk over one RFC 4180 record; None when it is damaged."""
    out, i, n = [], 0, len(line)
    if n == 0:
        return None
    while True:
        if i < n and line[i] == '"':
            i, text = i + 1, ""
            while True:
                if i >= n:
                    return None
                if line[i] == '"':
                    if line[i + 1 : i + 2] == '"':
                        text, i = text + '"', i + 2
                        continue
                    i += 1
                    break
                text, i = text + line[i], i + 1
            while i < n and line[i] != ",":
                if line[i] not in AFTER_QUOTE:
                    return None
                i += 1
            out.append(text)
        else:
            j = line.find(",", i)
            j = n if j < 0 else j
            out.append(line[i:j])
            i = j
        if i >= n:
            return out
        i += 1


def expected(line):
    line = line.removesuffix("\r")
    if len(line.encode()) > 65536 or "\n" in line or "\r" in line:
        return ("MALFORMED",)
    fields = fields_of(line.removeprefix("﻿"))
    if fields is None or len(fields) != 9:
        return ("MALFORMED",)
    if fields == list(EVENT_COLUMNS):
        return ("HEADER",)
    return ("EVENT", fields[1].strip(BLANKS), fields[3], fields[4], fields[6])


def random_line(rng):
    fields = []
    for _ in range(rng.choice([9] * 8 + [8, 10])):
        kind = rng.random()
        if kind < 0.5:
            fields.append(rng.choice(["", "a", "purchase", 'x"y', 'a""b', "1.50", " p "]))
        elif kind < 0.9:
            inner = "".join(rng.choice(["a", ",", '""', "é", " ", '""""', "\t"]) for _ in range(rng.randrange(4)))
            fields.append(f'"{inner}"' + rng.choice(["", "", "", " ", "\t", " ", "\x1c", "\xa0"]))
        else:
            atoms = ["a", '"', ",", "\r", "﻿", " ", "\x00", " ", "\n"]
            fields.append("".join(rng.choice(atoms) for _ in range(rng.randrange(4))))
    return ",".join(fields) + rng.choice([""] * 9 + ["\r"])


@pytest.mark.parametrize("fast_path", [True, False])
def test_against_character_walk(spark, fast_path):
    rng = random.Random(5)
    lines = [random_line(rng) for _ in range(8000)]
    lines += [HEADER_LINE, "﻿" + HEADER_LINE, ",".join(f'"{c}"' for c in EVENT_COLUMNS), "", "\r", "," * 8, "," * 9]
    lines += ['"' + '""' * 32000 + '",,,,,,,,', "a" * 65528 + "," * 8, "a" * 65529 + "," * 8, '"' * 65000]
    lines += ['"' + 'a,""' * 16000 + '",p,,1,c,,"2",,']
    rows = spark.createDataFrame(list(enumerate(lines)), "i int, value string").repartition(8)
    found = {}
    for r in parse_event_lines(rows, fast_path).collect():
        found[r.i] = (r.kind, r.event_type, r.category_id, r.category_code, r.price_text) if r.kind == "EVENT" else (r.kind,)
    assert [found[i] for i in range(len(lines))] == [expected(line) for line in lines]


def test_invalid_utf8_is_malformed(spark):
    rows = spark.sql("SELECT CAST(X'742C70757263686173652C312C312C612CFF2C312C752C73' AS STRING) AS value")
    assert parse_event_lines(rows).first().kind == "MALFORMED"


def event(kind="purchase", category="40", code="garden.rake", brand="oak", price="3.50", session="s7"):
    return f"2024-02-29 08:15:00 UTC,{kind},6,{category},{code},{brand},{price},u5,{session}"


CASES = [
    (event("view", price="free"), "id", "NON_PURCHASE", None),
    (event("cart"), "id", "NON_PURCHASE", None),
    (event("remove_from_cart", category=""), "id", "NON_PURCHASE", None),
    (event("refund"), "id", "UNKNOWN_EVENT", None),
    (event("PURCHASE"), "id", "UNKNOWN_EVENT", None),
    (event(category="", price="3.505"), "id", "INVALID_PRICE", None),
    (event(category=""), "id", "INVALID_GROUP", None),
    (event(category="40a"), "id", "INVALID_GROUP", None),
    (event(" purchase\t", category=" 0040 ", price="0.00"), "id", "VALID_PURCHASE", ("0040", 0, False)),
    (event(brand='"oak, ash"', session=""), "id", "VALID_PURCHASE", ("40", 350, False)),
    (event(brand='"the ""oak"""', session="\r"), "id", "VALID_PURCHASE", ("40", 350, False)),
    (event(category="8" * 256), "id", "VALID_PURCHASE", ("8" * 256, 350, False)),
    (event(category="8" * 257), "id", "INVALID_GROUP", None),
    (event().rpartition(",")[0], "id", "MALFORMED_CSV", None),
    (event(brand='"oak'), "id", "MALFORMED_CSV", None),
    ("", "id", "MALFORMED_CSV", None),
    ("\ufeff" + HEADER_LINE, "id", "HEADER", None),
    (event(code=""), "root", "VALID_PURCHASE", ("__UNKNOWN__", 350, True)),
    (event(code=""), "id", "VALID_PURCHASE", ("40", 350, False)),
    (event(code=".rake"), "root", "INVALID_GROUP", None),
    (event(code=".rake"), "code", "VALID_PURCHASE", (".rake", 350, False)),
    (event(code="garden.rake.iron"), "root", "VALID_PURCHASE", ("garden", 350, False)),
    (event(code="garden\trake"), "code", "INVALID_GROUP", None),
    (event(code="\tgarden.rake "), "code", "VALID_PURCHASE", ("garden.rake", 350, False)),
    (event(code="ß" * 128), "code", "VALID_PURCHASE", ("ß" * 128, 350, False)),
    (event(code="ß" * 129), "code", "INVALID_GROUP", None),
]


@pytest.mark.parametrize("mode", ["id", "code", "root"])
def test_outcomes(spark, mode):
    cases = [(line, reason, rest) for line, m, reason, rest in CASES if m == mode]
    rows = spark.createDataFrame([(i, line) for i, (line, _, _) in enumerate(cases)], "i int, value string")
    prepared = prepare(parse_event_lines(rows), f"category_{mode}", keep=("i",))
    found = {r.i: r for r in prepared.collect()}
    for i, (line, reason, rest) in enumerate(cases):
        assert found[i].reason == reason, line
        got = (found[i].group_key, found[i].price_minor, found[i].missing_code)
        assert got == (rest or (None, None, False)), line
