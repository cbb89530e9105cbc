import hashlib
import random

import pytest

from tillroll.functions.keys import sample_bucket
from tillroll.model import HEADER_LINE, POLICY_HASH
from tillroll.operators import manifest, preflight
from tillroll.sources import byteranges
from tillroll.sources.files import InputError, files_at, hadoop_path, list_csv, scan_lines, scan_lines_by_splits

GOOD = "t,purchase,1,1,a,b,1,u,s"


def write(path, *lines, end="\n"):
    path.write_bytes(("\n".join(lines) + end).encode() if lines else b"")
    return str(path)


def test_listing(spark, tmp_path):
    with pytest.raises(InputError):
        list_csv(spark, str(tmp_path))
    for name in ("b.csv", "a.csv", "a [1].csv", "c.txt"):
        write(tmp_path / name, HEADER_LINE)
    (tmp_path / "k=1").mkdir()
    write(tmp_path / "k=1" / "x.csv", HEADER_LINE)
    files = list_csv(spark, str(tmp_path))
    assert [f.uri.rsplit("/", 1)[1] for f in files] == ["a%20%5B1%5D.csv", "a.csv", "b.csv"]
    assert files_at(spark, [f.uri for f in files]) == files
    with pytest.raises(InputError):
        files_at(spark, [files[0].uri, files[0].uri])
    with pytest.raises(InputError):
        list_csv(spark, str(tmp_path / "c.txt"))


ODD_NAMES = ("é ü.csv", "a%20b.csv", "a+b&c=d;e,f.csv", "it's (1)!.csv", "x#y?.csv", "no\u00a0break.csv", "日本.csv", "[*]{a}.csv", "a~$@.csv")


def test_names_are_escaped_as_spark_reports_them(spark, tmp_path):
    for name in ODD_NAMES:
        write(tmp_path / name, HEADER_LINE)
    files = list_csv(spark, str(tmp_path))
    jpath, fs = hadoop_path(spark, str(tmp_path))
    spelled = [s.getPath().toString() for s in fs.listStatus(jpath)]
    asked = {spark._jvm.org.apache.hadoop.fs.Path(p).toUri().toString() for p in spelled}
    assert {f.uri for f in files} == asked and len(files) == len(ODD_NAMES)
    assert files_at(spark, [f.uri for f in files]) == sorted(files, key=lambda f: f.uri)
    for scan in (scan_lines, scan_lines_by_splits):
        assert {r.uri for r in scan(spark, files).select("uri").collect()} == asked
    with pytest.raises(InputError, match="No such input"):
        files_at(spark, [files[0].uri, files[0].uri + "x.csv"])


def test_many_names_need_no_call_each(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    for number in range(3000):
        (tmp_path / "in" / f"{number:05}.csv").write_bytes(b"x" * (number % 7))
    files = list_csv(spark, str(tmp_path / "in"))
    monkeypatch.setattr("tillroll.sources.files.hadoop_path", None)  # would be asked for each file
    found = files_at(spark, spark.createDataFrame([(f.uri,) for f in files], "uri string"))
    assert found == files and [f.bytes for f in found] == [i % 7 for i in range(3000)]


@pytest.mark.parametrize("scan", [scan_lines, scan_lines_by_splits])
@pytest.mark.parametrize("split_bytes", ["128m", "5000b", "333b"])
def test_offsets_do_not_depend_on_splits(spark, tmp_path, split_bytes, scan):
    rng, want = random.Random(1), {}
    for name, mark, tail in (("a b.csv", True, True), ("b.csv", False, False), ("c.csv", True, False), ("empty.csv", False, True)):
        lines = [("x" * rng.randrange(60) + rng.choice(["", "é", "\r", "﻿"])).encode() for _ in range(900)]
        lines = [b"first"] + lines + [b"end"] if name != "empty.csv" else []
        data = (b"\xef\xbb\xbf" if mark else b"") + b"\n".join(lines) + (b"\n" if tail and lines else b"")
        (tmp_path / name).write_bytes(data)
        position = 3 if mark else 0
        for i, line in enumerate(lines):
            want[f"file:{tmp_path}/{name}".replace(" ", "%20"), 0 if i == 0 else position] = line
            position += len(line) + 1
    settings = {"spark.sql.files.maxPartitionBytes": split_bytes, "spark.sql.files.openCostInBytes": "1b"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = scan(spark, list_csv(spark, str(tmp_path))).selectExpr("uri", "offset", "CAST(value AS BINARY) AS v").collect()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(rows) == len(want)
    assert {(r.uri, r.offset): bytes(r.v) for r in rows} == want


def test_lines_longer_than_a_read_and_ranges_without_a_line(spark, tmp_path, monkeypatch):
    texts = [b"a" * 100, b"", b"b" * 7, b"c" * 300, b"d"]
    (tmp_path / "x.csv").write_bytes(b"\n".join(texts))
    size, uri = (tmp_path / "x.csv").stat().st_size, f"file:{tmp_path}/x.csv"
    monkeypatch.setattr(byteranges, "_READ_BYTES", 16)
    reader = byteranges.line_source()({"files": f'[["{uri}", {size}]]', "taskBytes": "10"}).reader(None)
    got = [
        (offset, value)
        for part in reader.partitions()
        for batch in reader.read(part)
        for offset, value in zip(batch["offset"].to_pylist(), batch["value"].to_pylist(), strict=True)
    ]
    starts = [sum(len(t) + 1 for t in texts[:i]) for i in range(len(texts))]
    assert got == list(zip(starts, texts, strict=True))


def test_small_files_share_a_task():
    files = [("a", 5), ("b", 5), ("c", 25), ("d", 0), ("e", 1)]
    assert byteranges.tasks_of(files, 10) == [[("a", 0, 5), ("b", 0, 5)], [("c", 0, 10)], [("c", 10, 20)], [("c", 20, 25), ("e", 0, 1)]]


def test_each_byte_is_read_once(spark, tmp_path):
    write(tmp_path / "a.csv", HEADER_LINE, *[GOOD] * 50)
    plan = scan_lines(spark, list_csv(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan") == 1 and "Join" not in plan and "Exchange" not in plan


def rules_of(spark, path, mode="category_id"):
    files = list_csv(spark, path)
    counted = {r.rule: r.n for r in preflight.rule_counts(preflight.inspect_files(spark, files, mode)).collect()}
    located = preflight.line_violations(scan_lines(spark, files), mode).collect()
    return counted, sorted((r.rule, r.offset) for r in located)


def test_preflight_rules(spark, tmp_path):
    after = len(HEADER_LINE) + 1
    assert rules_of(spark, write(tmp_path / "ok.csv", HEADER_LINE, GOOD, end="")) == ({}, [])
    assert rules_of(spark, write(tmp_path / "bom.csv", "﻿" + HEADER_LINE, GOOD)) == ({}, [])
    assert rules_of(spark, write(tmp_path / "crlf.csv", HEADER_LINE + "\r", GOOD + "\r")) == ({}, [])
    assert rules_of(spark, write(tmp_path / "none.csv", GOOD)) == ({"missing_header": 1, "no_header": 1}, [("missing_header", 0)])
    assert rules_of(spark, write(tmp_path / "empty.csv")) == ({"no_header": 1}, [])
    cr = write(tmp_path / "cr.csv", HEADER_LINE, 't,purchase,1,1,a,"two\rlines",1,u,s')
    assert rules_of(spark, cr) == ({"malformed_line": 1}, [("malformed_line", after)])
    lf = write(tmp_path / "lf.csv", HEADER_LINE, 't,purchase,1,1,a,"two', 'lines",1,u,s')
    assert rules_of(spark, lf)[0] == {"malformed_line": 2}
    wide = write(tmp_path / "wide.csv", HEADER_LINE, f"t,view,1,1, {'a' * 256},b,1,u,s")
    assert rules_of(spark, wide, "category_root") == ({"group_field_too_long": 1}, [("group_field_too_long", after)])
    assert rules_of(spark, wide, "category_id") == ({}, [])
    long = write(tmp_path / "long.csv", HEADER_LINE, "a" * 65536 + "," * 8)
    assert rules_of(spark, long) == ({"line_too_long": 1}, [("line_too_long", after)])
    (tmp_path / "bytes.csv").write_bytes(HEADER_LINE.encode() + b"\nt,view,1,1,a,\xff,1,u,s\n")
    assert rules_of(spark, str(tmp_path / "bytes.csv")) == ({"invalid_utf8": 1}, [("invalid_utf8", after)])


def test_statistics_of_many_splits(spark, tmp_path):
    write(tmp_path / "a.csv", HEADER_LINE, *[GOOD] * 500)
    write(tmp_path / "b.csv", *[GOOD] * 400, HEADER_LINE)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        rows = preflight.inspect_files(spark, list_csv(spark, str(tmp_path)), "category_id").orderBy("uri").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r.lines, r.valid_purchases, r.has_header) for r in rows] == [(501, 500, True), (401, 400, False)]


def test_manifest_and_fingerprint(spark, tmp_path, monkeypatch):
    write(tmp_path / "a.csv", HEADER_LINE, GOOD)
    write(tmp_path / "b c.csv", HEADER_LINE, GOOD, GOOD)
    files = list_csv(spark, str(tmp_path))
    want = [(f.uri, f.bytes, hashlib.sha256((tmp_path / n).read_bytes()).hexdigest()) for f, n in zip(files, ("a.csv", "b c.csv"))]
    whole = manifest.file_manifest(spark, files)
    assert sorted(map(tuple, whole.select("uri", "bytes", "sha256").collect())) == want
    monkeypatch.setattr(manifest, "_WHOLE_FILE_BYTES", files[0].bytes)  # the second file is streamed
    streamed = manifest.file_manifest(spark, files)
    assert sorted(map(tuple, streamed.collect())) == want
    text = POLICY_HASH + "\n" + "".join(f"{u}\t{b}\t{s}\n" for u, b, s in want)
    assert manifest.manifest_fingerprint(whole).first().input_fingerprint == hashlib.sha256(text.encode()).hexdigest()
    with pytest.raises(Exception, match="duplicate manifest entry"):
        manifest.manifest_fingerprint(whole.unionAll(whole)).collect()
    assert manifest.input_drift(whole, streamed).count() == 0
    write(tmp_path / "a.csv", HEADER_LINE, GOOD.replace(",1,u", ",2,u"))
    changed = manifest.input_drift(spark.createDataFrame(want, whole.schema), manifest.file_manifest(spark, files[:1])).collect()
    assert sorted((r.uri, r.change) for r in changed) == [(files[0].uri, "content"), (files[1].uri, "missing")]


def test_policy_hash():
    assert POLICY_HASH == "e8cfaa885aa0cabdc51d54c4ee15e5c7a82b70c3cb69406582ed58c47ed2e117"


@pytest.mark.parametrize("seed,buckets", [(21, 1_000_000), (-7, 1000), (0, 1), (2**63 - 1, 17)])
def test_sample_bucket(spark, seed, buckets):
    offsets = [0, 1, 95, 2**40, 2**62, 12345]
    rows = spark.createDataFrame([("file:/d/é.csv", o) for o in offsets], "uri string, offset bigint")
    got = [r.b for r in rows.selectExpr(f"{sample_bucket('uri', 'offset', seed, buckets)} AS b").collect()]
    digests = [
        hashlib.sha256("file:/d/é.csv".encode() + b"\0" + seed.to_bytes(8, "big", signed=True) + o.to_bytes(8, "big")).digest()
        for o in offsets
    ]
    assert got == [int.from_bytes(d[:4], "big", signed=True) % buckets for d in digests]
