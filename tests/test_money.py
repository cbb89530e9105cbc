import random
from decimal import Decimal, InvalidOperation

import pytest

from tillroll.functions.money import average_minor, format_minor, with_minor

BLANKS = "".join(map(chr, range(0x21)))


def minor_of(text):
    """Independent rule: exact decimal, two places at most, not negative, fits 64 bits."""
    text = text.strip(BLANKS)
    if not text or any(c not in "0123456789.eE+-" for c in text):
        return None
    try:
        value = Decimal(text)
    except InvalidOperation:
        return None
    sign, digits, exponent = value.as_tuple()
    number = int("".join(map(str, digits)))
    if number == 0:
        return 0
    places = exponent + 2
    if sign or places > 40:
        return None
    if places < 0:
        number, rest = divmod(number, 10**-places) if places > -400 else (0, 1)
        if rest:
            return None
    else:
        number *= 10**places
    return number if number < 2**63 else None


def parse(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = {r.i: r.m for r in with_minor(rows, "t", "m").select("i", "m").collect()}
    return [found[i] for i in range(len(texts))]


def test_spellings(spark):
    expected = {
        "12.300": 1230, "12.301": None, "1e2": 10000, ".5": 50, "5.": 500, "+5": 500, "-0": 0, "-0.00": 0, "NaN": None,
        "Infinity": None, "": None, "-1": None, ".": None, "+": None, "e5": None, "1e": None, "1 2": None, "0x1": None,
        "1e99999999999": None, "0e99999999999": None, "1e2147483647": None, "1e-2147483648": None, "0e2147483647": 0,
        "1e17": None, "1e16": 10**18, "-0e3": 0, "0.0e-2147483648": None, "\t 7.00\n": 700, "1d": None, "1f": None,
        "92233720368547758.07": 2**63 - 1, "92233720368547758.08": None, "1" + "0" * 60 + "e-60": 100,
        "0." + "0" * 50 + "1": None, "0" * 60 + "3.10" + "0" * 60: 310, "12.34500e1": 12345, "12.345e0": None,
        "١٢.٥": 1250, "７": 700, "1.00000000000000000000000000000000000000001": None,
    }
    assert dict(zip(expected, parse(spark, list(expected)))) == expected


def test_against_exact_decimals(spark):
    rng = random.Random(11)
    texts = []
    for _ in range(6000):
        whole = rng.choice(["", "0", "00", str(rng.randrange(10 ** rng.randrange(1, 20)))])
        point = rng.choice(["", ".", "." + str(rng.randrange(10 ** rng.randrange(1, 5))) + "0" * rng.randrange(4)])
        power = rng.choice(["", "", "", f"e{rng.randrange(-25, 25)}", f"E+{rng.randrange(20):03d}"])
        texts.append(rng.choice(["", "", "+", "-", " "]) + whole + point + power)
    assert parse(spark, texts) == [minor_of(t) for t in texts]


def test_format_and_average(spark):
    rows = spark.createDataFrame([(1, 2), (6000, 3), (3, 3), (2**63 - 1, 2**62), (5, 0), (0, 7), (2**63 - 1, 1)], "s bigint, n bigint")
    got = rows.selectExpr(f"{format_minor('s')} AS f", f"{average_minor('s', 'n')} AS a").collect()
    assert [r.f for r in got[:4]] == ["0.01", "60.00", "0.03", "92233720368547758.07"]
    assert [r.a for r in got] == [1, 2000, 1, 2, None, 0, 2**63 - 1]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sum_overflow_fails_in_any_mode(spark, ansi):
    from tillroll.operators.aggregate import merge_states

    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        states = spark.createDataFrame([("a", 2**63 - 1, 1), ("a", 1, 1)], "group_key string, sum_minor bigint, purchase_count bigint")
        with pytest.raises(Exception, match="leaves the range"):
            merge_states(states).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
