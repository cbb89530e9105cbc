import json
import threading
from pathlib import Path

import pytest

from tillroll.model import HEADER_LINE
from tillroll.plans import runs
from tillroll.sinks import writers
from tillroll.sources.artifacts import read_artifact, read_dictionary, read_manifest
from tillroll.sources.files import InputError, list_csv
from tillroll.sources.results import parse_result_lines, read_result_lines
from tillroll.operators import compare, profile
from tillroll.operators.aggregate import partial
from tillroll.operators.prepare import prepare
from tillroll.operators.summary import run_summary
from tillroll.functions.csvline import parse_event_lines

EVENTS = [
    "2024-05-04 07:00:00 UTC,purchase,77,31,tools.saw,acme,4.50,u7,s1",
    "2024-05-04 07:01:00 UTC,purchase,78,31,tools.saw,acme,8.00,u7,s1",
    "2024-05-04 07:02:00 UTC,cart,78,31,tools.saw,acme,70.00,u8,s2",
    '2024-05-04 07:03:00 UTC,purchase,12,9,,"Saw, Sons",1.01,u9,',
    "2024-05-04 07:04:00 UTC,purchase,12,9,,acme,2.00,u9,s3",
]
RESULT = ["31\t12.50\t2\t6.25", "9\t3.01\t2\t1.51"]


@pytest.fixture
def events(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = tmp_path / "in" / "events.csv"
    path.write_text("\n".join([HEADER_LINE, *EVENTS]) + "\n")
    return path


def result(path):
    return sorted(line for part in Path(path).glob("part-*") for line in part.read_text().splitlines())


def test_every_route_gives_one_result(spark, events, tmp_path):
    files = list_csv(spark, str(events.parent))
    profiled = runs.run_profile(spark, files, "category_id")
    assert {tuple(r) for r in profiled.reasons.collect()} == {("HEADER", 1), ("VALID_PURCHASE", 4), ("NON_PURCHASE", 1)}
    runs.write_dictionary(profiled, str(tmp_path / "groups"))
    dictionary = read_dictionary(spark, str(tmp_path / "groups"))
    runs.write_dictionary_object(profiled, str(tmp_path / "groups.json"))
    single = read_dictionary(spark, str(tmp_path / "groups.json"))
    assert runs.check_dictionary(single, profiled.preflight.fingerprint, "category_id").exceptAll(dictionary.select("id", "group_key")).isEmpty()
    for strategy in ("v1", "v2", "v4", "v5"):
        out = str(tmp_path / strategy)
        record = runs.run_aggregate(spark, files, out, "category_id", strategy, dictionary)
        assert record["success"] and record["counters"]["VALID_PURCHASE"] == 4
        assert result(out) == RESULT
        assert runs.run_compare(spark, str(tmp_path / "v1"), out).count() == 0
        stored = json.loads(next(Path(out, "_run-manifest.json").glob("part-*")).read_text())
        assert stored["inputFingerprint"] == profiled.preflight.fingerprint
    expected = b"group_key,total_revenue,purchase_count,average_revenue\r\n31,12.50,2,6.25\r\n9,3.01,2,1.51\r\n"
    runs.run_export(spark, str(tmp_path / "v5"), str(tmp_path / "out.csv"), single=True)
    assert (tmp_path / "out.csv").read_bytes() == expected
    runs.run_export(spark, str(tmp_path / "v5"), str(tmp_path / "out"))
    assert b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*"))) == expected
    # A dictionary of other input, or a damaged one, is refused.
    with pytest.raises(runs.RunFailed, match="of another input or damaged"):
        runs.check_dictionary(dictionary, "other", "category_id")
    for stored in (dictionary, single):
        with pytest.raises(runs.RunFailed, match="of another input or damaged"):
            runs.check_dictionary(stored.where("id = 0"), profiled.preflight.fingerprint, "category_id")
    with pytest.raises(Exception, match="More than 1 groups"):
        runs.run_profile(spark, files, "category_id", max_keys=1)
    with pytest.raises(runs.RunFailed, match="2 groups, more than 1"):
        runs.run_aggregate(spark, files, str(tmp_path / "limited"), max_keys=1)


def test_no_purchase(spark, tmp_path):
    (tmp_path / "e.csv").write_text(f"{HEADER_LINE}\n{EVENTS[2]}\n")
    record = runs.run_aggregate(spark, list_csv(spark, str(tmp_path / "e.csv")), str(tmp_path / "out"))
    assert record["groups"] == 0 and result(tmp_path / "out") == []


def test_failures_publish_nothing(spark, events, tmp_path, monkeypatch):
    files = list_csv(spark, str(events))
    out = tmp_path / "out"
    checked = runs.run_preflight(spark, files, "category_id")
    runs.write_preflight(checked, str(tmp_path / "m.json"), str(tmp_path / "p.json"))
    named, entries = runs.files_of_manifest(spark, str(tmp_path / "m.json"))
    assert named == files

    # The input changes after the manifest: a changed price keeps every count.
    original = events.read_text()
    events.write_text(original.replace("4.50", "4.60"))
    with pytest.raises(runs.RunFailed, match="not the same any more"):
        runs.run_aggregate(spark, files, str(out), stored_manifest=entries)
    events.write_text(original)

    # The input changes during the run.
    stage = writers.stage_result
    monkeypatch.setattr(writers, "stage_result", lambda s, p: (stage(s, p), events.write_text(original.replace("8.00", "8.10"))))
    with pytest.raises(runs.RunFailed, match="not the same any more"):
        runs.run_aggregate(spark, files, str(out))
    monkeypatch.undo()

    # A damaged line, found by preflight, or turning up only at run time.
    events.write_text(original + "broken\n")
    with pytest.raises(runs.RunFailed, match="malformed_line"):
        runs.run_aggregate(spark, list_csv(spark, str(events)), str(out))
    late = runs.run_preflight(spark, list_csv(spark, str(events)), "category_id")
    late.errors.clear()
    monkeypatch.setattr(runs, "run_preflight", lambda *a, **b: late)
    with pytest.raises(runs.RunFailed, match="malformed during the run"):
        runs.run_aggregate(spark, files, str(out), failed_record=str(tmp_path / "failed.json"))
    monkeypatch.undo()
    events.write_text(original)
    failed = runs.read_records(spark, [str(tmp_path / "failed.json")]).first()
    assert (failed.success, failed.variant, failed.job_ms) == (False, "partial", None) and failed.end_to_end_ms >= 0

    # A stored report of another mode, or of an input that has changed since.
    with pytest.raises(runs.RunFailed, match="another input or mode"):
        runs.run_aggregate(spark, files, str(out), "category_code", stored_report=str(tmp_path / "p.json"))
    events.write_text(original.replace("4.50", "4.60"))
    with pytest.raises(runs.RunFailed, match="another input or mode"):
        runs.run_aggregate(spark, files, str(out), stored_report=str(tmp_path / "p.json"))
    events.write_text(original)
    ok = str(tmp_path / "ok")
    assert runs.run_aggregate(spark, files, ok, stored_manifest=entries, stored_report=str(tmp_path / "p.json"))["success"]

    # An existing output stays as it is; output and input may not overlap.
    out.mkdir()
    (out / "keep").write_text("x")
    with pytest.raises(writers.OutputError, match="there already"):
        runs.run_aggregate(spark, files, str(out))
    assert [p.name for p in out.iterdir()] == ["keep"]
    with pytest.raises(writers.OutputError, match="lies in"):
        runs.run_aggregate(spark, files, str(events / "x"))
    assert not list(tmp_path.glob("out.tmp-*"))


def test_first_errors_are_capped(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("\n".join(["broken"] * 50) + "\n")
    checked = runs.run_preflight(spark, list_csv(spark, str(tmp_path / "bad.csv")), "category_id")
    assert len(checked.errors) == 20 and not checked.valid
    assert checked.errors[0].startswith("malformed_line") and checked.errors[0].endswith("@0")
    with pytest.raises(runs.RunFailed):
        runs.write_preflight(checked, str(tmp_path / "m"), str(tmp_path / "p"))


def test_profile_belongs_to_its_input(spark, events, tmp_path, monkeypatch):
    files = list_csv(spark, str(events))
    profiled = runs.run_profile(spark, files, "category_id")
    runs.write_profile(profiled, str(tmp_path / "profile"))
    report = runs.read_profiles(spark, [str(tmp_path / "profile")]).first()
    assert report.inputFingerprint == profiled.preflight.fingerprint and report.validPurchaseCount == 4
    assert report.counters == {"HEADER": 1, "VALID_PURCHASE": 4, "NON_PURCHASE": 1}
    groups = read_artifact(spark, str(tmp_path / "profile" / "groups.json"), "group_key string, purchase_count bigint")
    assert {tuple(r) for r in spark.read.schema(groups.schema).json(str(tmp_path / "profile" / "groups.json")).collect()} == {
        ("31", 2), ("9", 2)
    }
    build = runs.dic.build_dictionary

    def meanwhile(*a):
        events.write_text(events.read_text().replace(",31,", ",32,"))
        return build(*a)

    monkeypatch.setattr(runs.dic, "build_dictionary", meanwhile)
    with pytest.raises(runs.RunFailed, match="not the same any more"):
        runs.run_profile(spark, files, "category_id")


def test_records_to_summary(spark, events, tmp_path):
    files = list_csv(spark, str(events))
    profiled = runs.run_profile(spark, files, "category_id")
    runs.write_profile(profiled, str(tmp_path / "profile"))
    paths = []
    for variant in ("v2", "v4"):
        for number in range(3):
            out = str(tmp_path / f"{variant}-{number}")
            runs.run_aggregate(spark, files, out, "category_id", variant, profiled.dictionary, warmup=number == 0)
            paths.append(f"{out}/_run-manifest.json")
    records = runs.read_records(spark, paths, runs.read_profiles(spark, [str(tmp_path / "profile")]))
    rows = {r.variant: r for r in records.where("NOT warmup").collect()}
    assert rows["v2"].profile_ms == 0 and rows["v4"].profile_ms == profiled.elapsed_ms
    got = {r.variant: r for r in run_summary(records, ["v2", "v4"], repeats=2).collect()}
    assert got["v2"].runs == got["v4"].runs == 2 and got["v4"].effective_variant == "dictionary"
    assert got["v4"].with_profile_median_ms == got["v4"].end_to_end_median_ms + profiled.elapsed_ms
    assert got["v2"].speedup == 1.0 and got["v2"].shuffle_median_bytes is None


def test_more_than_a_hundred_thousand_groups(spark, tmp_path):
    rows = (f"t,purchase,1,{i},a,b,1.00,u,s" for i in range(100_001))
    (tmp_path / "e.csv").write_text("\n".join([HEADER_LINE, *rows]) + "\n")
    files = list_csv(spark, str(tmp_path / "e.csv"))
    groups = runs.run_profile(spark, files, "category_id").dictionary
    for strategy in ("partial", "packed"):
        out = str(tmp_path / strategy)
        assert runs.run_aggregate(spark, files, out, strategy=strategy, dictionary=groups)["groups"] == 100_001
    runs.run_export(spark, str(tmp_path / "packed"), str(tmp_path / "csv"))
    lines = b"".join(p.read_bytes() for p in sorted((tmp_path / "csv").glob("part-*"))).decode().split("\r\n")
    assert len(lines) == 100_003 and lines[1:-1] == sorted(lines[1:-1], key=lambda x: x.split(",")[0])


def test_empty_sample_is_one_header(spark, tmp_path):
    (tmp_path / "e.csv").write_text(f"{HEADER_LINE}\n")
    files = list_csv(spark, str(tmp_path / "e.csv"))
    checked = runs.run_preflight(spark, files, "category_id")
    runs.run_sample(spark, files, checked.manifest, str(tmp_path / "s"), 0.5)
    assert [p.read_text() for p in (tmp_path / "s").glob("*.csv")] == [HEADER_LINE + "\n"]


def test_failed_sample_leaves_nothing(spark, events, tmp_path, monkeypatch):
    files = list_csv(spark, str(events))
    checked = runs.run_preflight(spark, files, "category_id")

    def broken(*a):
        raise OSError("no space")

    monkeypatch.setattr(runs, "write_preflight", broken)
    with pytest.raises(OSError):
        runs.run_sample(spark, files, checked.manifest, str(tmp_path / "s"), 1.0)
    assert not list(tmp_path.glob("s*"))


def test_sample(spark, tmp_path):
    lines = [f"t,{'view' if i % 2 else 'purchase'},{i},{i % 5},a,b,{i}.00,u,s" for i in range(400)]
    (tmp_path / "e.csv").write_text("\n".join([HEADER_LINE, *lines]) + "\n")
    files = list_csv(spark, str(tmp_path / "e.csv"))
    checked = runs.run_preflight(spark, files, "category_id")
    kept = {}
    for name, rate, seed in (("all", 1.0, 21), ("a", 0.3, 21), ("b", 0.3, 21), ("other", 0.3, 22)):
        target = str(tmp_path / name)
        runs.run_sample(spark, files, checked.manifest, target, rate, seed)
        parts = [p.read_text().splitlines() for p in Path(target).glob("*.csv")]
        assert all(p[0] == HEADER_LINE for p in parts)
        kept[name] = [line for p in parts for line in p[1:]]
        assert read_artifact(spark, target + ".sample.json").first().rate == rate
        assert read_manifest(spark, target + ".manifest.json").count() == len(parts)
    assert kept["all"] == lines
    assert kept["a"] == kept["b"] != kept["other"]
    assert 60 < len(kept["a"]) < 180 and any(",view," in line for line in kept["a"])
    for rate in (0, 1.01, float("nan")):
        with pytest.raises(ValueError, match="rate"):
            runs.run_sample(spark, files, checked.manifest, str(tmp_path / "x"), rate)


@pytest.mark.parametrize(
    "text,expected,valid,rules",
    [
        ("A\t60.00\t3\t20.00\n", 3, True, []), ("A\t60.00\t3\t20.00\n", 4, False, []),
        ("A\t60.00\t3\t20.00\nA\t60.00\t3\t20.00\n", 6, False, ["duplicate_key"]), ("A\t60.00\t3\t10.00\n", 3, False, ["average"]),
        ("", 0, True, []), ("A\t60.0\t3\t20.00\n", 3, False, ["total"]), ("A\t0.00\t0\t0.00\n", 0, False, ["count"]),
        ("\t60.00\t3\t20.00\n", 3, False, ["empty_key"]), ("A\t60.00\t3\n", 3, False, ["columns"]), ("A\t-1.00\t1\t-1.00\n", 1, False, ["total"]),
    ],
)
def test_result_rules(spark, tmp_path, text, expected, valid, rules):
    with pytest.raises(InputError):
        read_result_lines(spark, str(tmp_path))
    (tmp_path / "part-r-00000").write_text(text)
    parsed = parse_result_lines(read_result_lines(spark, str(tmp_path)))
    assert compare.validate_result(parsed, expected).first().valid is valid
    assert [r.violation for r in compare.result_violations(parsed).collect()] == rules


def test_compare_names_each_difference(spark, tmp_path):
    for name, text in (("l", "A\t1.00\t1\t1.00\nB\t2.00\t1\t2.00\nC\t3.00\t1\t3.00\n"), ("r", "B\t2.00\t2\t1.00\nC\t3.00\t1\t3.00\nD\t3.00\t1\t3.00\n")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-r-00000").write_text(text)
    diff = runs.run_compare(spark, str(tmp_path / "l"), str(tmp_path / "r"))
    assert {(r.group_key, r.difference) for r in diff.collect()} == {("A", "only_left"), ("B", "differs"), ("D", "only_right")}


def test_export_quotes_unusual_keys(spark, tmp_path):
    keys = ['say "x"', "a,b", "plain", "#1", "é", "end ", "mid dle"]
    rows = spark.createDataFrame([(k, 100, 1) for k in keys], "group_key string, sum_minor bigint, purchase_count bigint")
    from tillroll.operators.aggregate import result_rows

    writers.export_csv(result_rows(rows), str(tmp_path / "x.csv"), single=True)
    got = (tmp_path / "x.csv").read_bytes().decode().split("\r\n")[1:-1]
    fields = [line.removesuffix(",1.00,1,1.00") for line in got]
    assert fields == ['"#1"', '"a,b"', '"end "', "mid dle", "plain", '"say ""x"""', '"é"']


def test_artifacts(spark, tmp_path):
    one = spark.range(1)
    writers.write_artifact(one, str(tmp_path / "a.json"))
    with pytest.raises(writers.OutputError):
        writers.write_artifact(one, str(tmp_path / "a.json"))
    (tmp_path / "big.json").write_bytes(b" " * 1025)
    with pytest.raises(InputError, match="more than 1024 bytes"):
        read_artifact(spark, str(tmp_path / "big.json"), max_bytes=1024)
    foreign = {"schemaVersion": 1, "policyHash": "other", "files": [{"uri": "file:/x.csv", "sha256": "0" * 64, "bytes": 1}]}
    (tmp_path / "m.json").write_text(json.dumps(foreign, indent=1))
    with pytest.raises(Exception, match="schema or policy"):
        read_manifest(spark, str(tmp_path / "m.json")).collect()


def test_reconciliation(spark):
    lines = spark.createDataFrame([("f", 0, HEADER_LINE)] + [("f", i + 1, e) for i, e in enumerate(EVENTS)], "uri string, offset bigint, value string")
    from pyspark.sql import functions as F

    from tillroll.operators.preflight import file_statistics

    prepared = prepare(parse_event_lines(lines), "category_id")
    statistics = file_statistics(lines, "category_id", F.col("offset"), F.lit(True))
    row = compare.reconciliation(profile.tally(prepared), statistics, partial(prepared)).first()
    assert tuple(row) == (4, 4, 4, True)
    short = partial(prepared).where("group_key = '9'")
    assert compare.reconciliation(profile.tally(prepared), statistics, short).first().reconciled is False


def test_of_many_writers_one_publishes(spark, tmp_path):
    target, won, lost = str(tmp_path / "out"), [], []
    staged = [tmp_path / f"staged-{i}" for i in range(8)]
    for folder in staged:
        folder.mkdir()
        (folder / "who").write_text(folder.name)
    ready = threading.Barrier(len(staged))

    def publish(folder):
        ready.wait()
        try:
            writers.publish(spark, str(folder), target)
            won.append(folder.name)
        except writers.OutputError as error:
            lost.append(str(error))

    threads = [threading.Thread(target=publish, args=(folder,)) for folder in staged]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert len(won) == 1 and len(lost) == 7
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["who"] and (tmp_path / "out" / "who").read_text() == won[0]
    assert not list(tmp_path.glob("*.claim"))


def test_a_claim_keeps_others_out(spark, tmp_path):
    (tmp_path / "staged").mkdir()
    (tmp_path / "out.claim").touch()
    with pytest.raises(writers.OutputError, match="another writer"):
        writers.publish(spark, str(tmp_path / "staged"), str(tmp_path / "out"))
    writers.release_claim(spark, str(tmp_path / "out"))
    writers.publish(spark, str(tmp_path / "staged"), str(tmp_path / "out"))
    with pytest.raises(writers.OutputError, match="cannot take"):
        writers.publish(spark, str(tmp_path / "out"), str(tmp_path / "out"))


def test_many_parts_become_one_file(spark, tmp_path):
    rows = spark.range(50_000).selectExpr(
        "concat('k', id * 7919 % 50000) AS group_key", "id AS sum_minor", "1L AS purchase_count", "'1.00' AS total_revenue", "'1.00' AS average_revenue"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.export_csv(rows.repartition(5), str(tmp_path / "parts"))
        writers.export_csv(rows.repartition(3), str(tmp_path / "one.csv"), single=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "parts").glob("part-*"))
    whole = (tmp_path / "one.csv").read_bytes()
    assert len(parts) > 1 and whole == b"".join(p.read_bytes() for p in parts)
    lines = whole.decode().split("\r\n")
    assert len(lines) == 50_002 and lines[1:-1] == sorted(lines[1:-1]) and not list(tmp_path.glob("*tmp*"))


def test_a_report_vouches_for_lines_it_knows(spark, events, tmp_path, monkeypatch):
    files = list_csv(spark, str(events))
    checked = runs.run_preflight(spark, files, "category_id")
    runs.write_preflight(checked, str(tmp_path / "m.json"), str(tmp_path / "p.json"))
    digested = []
    digest = runs.manifest.file_manifest
    monkeypatch.setattr(runs.manifest, "file_manifest", lambda *a: digested.append(a) or digest(*a))
    report, entries = str(tmp_path / "p.json"), read_manifest(spark, str(tmp_path / "m.json"))
    record = runs.run_aggregate(spark, files, str(tmp_path / "a"), stored_report=report, stored_manifest=entries)
    assert record["inputFingerprint"] == checked.fingerprint and not digested
    # A line that stands twice in the place of another that stands twice is other content.
    twice = [EVENTS[0], EVENTS[0], EVENTS[2]], [EVENTS[1].replace("8.00", "4.50"), EVENTS[1].replace("8.00", "4.50"), EVENTS[2]]
    contents = []
    for lines in twice:
        events.write_text("\n".join([HEADER_LINE, *lines]) + "\n")
        contents.append(runs.run_preflight(spark, list_csv(spark, str(events)), "category_id").content)
    assert contents[0] != contents[1]
    with pytest.raises(runs.RunFailed):
        runs.run_aggregate(spark, list_csv(spark, str(events)), str(tmp_path / "b"), stored_report=report, stored_manifest=entries)
    assert digested
