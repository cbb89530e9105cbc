import random
import re

import pytest

from tests.llm.conftest import clashing
from tillroll.llm import urlrules

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
URLS = [
    None, "", "nourl", "HTTP://A.B.NET/", "http://net", "http://Net/x?y#z", "x://example.NET/en/q", "://foo.example.com/de/",
    "http://h?a/b", "http://fr.org/fr/#x", "http://xnet/", "http://a.example.com/De/", "http://u://b.org/fr/", "http://ÄNet/",
    "http://example.net/en", "http://" + "a." * 3000 + "net/" + "p/" * 3000,
]


def plain(url):
    host = path = ""
    if url and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in RULES:
        name, slash, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + start):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return host, path, best[1] if best else None, best[0] if best else "allow"


def tables(spark, pages, labels=()):
    pages = spark.createDataFrame(list(pages), "page_id long, url string")
    return clashing(pages), clashing(spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int"))


def test_stated_rules(spark):
    rows = list(enumerate(URLS)) + [(3, URLS[3]), (None, "http://net/")]
    got = urlrules.judge(*tables(spark, rows), RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain(URLS[r.page_id] if r.page_id is not None else "http://net/")


def test_mined_rules_block(spark):
    rnd = random.Random(15)
    pages, labels = [], []
    for i in range(600):
        spam, feed = rnd.random() < 0.3, rnd.random() < 0.5
        host = f"{'win-cash' if spam else 'site'}{rnd.randint(1, 30)}.example.org"
        pages.append((i, f"http://{host}/{rnd.choice(['a', 'b'])}/{i}" + ("?utm=feed" if feed else "")))
        bad = spam and feed or rnd.random() < 0.05  # only together
        if rnd.random() < 0.7:
            labels.append((i, int(not bad), None))
    got = {r.page_id: r for r in urlrules.judge(*tables(spark, pages, labels), RULES, min_confidence=0.8).collect()}
    for i, url in pages:
        assert (got[i].verdict == "block") == ("win-cash" in url and "utm" in url), got[i]
    blocked = [r for r in got.values() if r.mined_rule]
    assert blocked and all("query=utm=feed" in r.mined_rule and r.confidence >= 0.8 for r in blocked)


def test_confidence_equals_counts(spark):
    pages = [(i, f"http://{'x' if i % 3 else 'y'}.org/{'p' if i % 2 else 'q'}/1") for i in range(300)]
    labels = [(i, 0 if i % 3 and i % 5 else 1, 0) for i in range(300)]
    split = urlrules.with_parts(spark.createDataFrame([(i, f"{u}?{i}a") for i, u in pages], "page_id long, url string"))
    known = split.join(spark.createDataFrame(labels, "page_id long, quality int, toxic int"), "page_id")
    known = known.select(urlrules.tokens().alias("tokens"), (known.quality == 0).alias("bad")).cache()
    baskets = [(set(r.tokens), r.bad) for r in known.collect()]
    rules = urlrules.mine(known, 0.05, 10, 0.5).collect()
    assert rules
    for r in rules:
        hit = [bad for tokens, bad in baskets if set(r.antecedent) <= tokens]
        assert r.confidence == pytest.approx(sum(hit) / len(hit)) and sum(hit) >= 15
        assert r.rarest in r.antecedent


@pytest.mark.parametrize("others", [500, 25_000])
def test_thirty_bad_pages_make_a_rule_at_every_size(spark, others):
    frame = spark.range(others + 30).selectExpr(
        "id AS page_id", "if(id < 30, concat('http://rare.org/', id, 'a'), concat('http://site', id % 50, '.com/', id, 'a')) AS url"
    )
    labels = frame.selectExpr("page_id AS doc_id", "if(page_id < 30 OR page_id % 10 = 0, 0, 1) AS quality", "0 AS toxic")
    blocked = urlrules.judge(frame, labels, [], min_confidence=0.9).where("verdict = 'block'")
    assert {r.page_id for r in blocked.collect()} == set(range(30))


def test_empty_tables(spark):
    assert urlrules.judge(*tables(spark, []), RULES).count() == 0
    got = urlrules.judge(*tables(spark, [(1, "http://a.org/")], [(None, None, None), (1, None, None)]), RULES).first()
    assert (got.verdict, got.rule, got.mined_rule) == ("allow", None, None)
