"""The user-level runs: preflight, profile, aggregate, sample, compare and export."""

from __future__ import annotations

import datetime
import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tillroll import model as M
from tillroll.functions.csvline import parse_event_lines
from tillroll.model import DEFAULT_SEED, GroupMode
from tillroll.operators import aggregate as agg
from tillroll.operators import compare, manifest, preflight, profile, sample
from tillroll.operators import dictionary as dic
from tillroll.session import materialize
from tillroll.sinks import writers
from tillroll.sources.artifacts import read_artifact, read_manifest
from tillroll.sources.files import InputFile, files_at, list_csv, scan_lines
from tillroll.sources.results import parse_result_lines, read_result_lines


class RunFailed(RuntimeError):
    """A check failed; no output was published."""


_REPORT = (
    "schemaVersion int, inputFingerprint string, groupMode string, validPurchaseCount bigint, lines bigint, "
    "errors array<string>, contentDigest string"
)
_PROFILE = (
    "schemaVersion int, inputFingerprint string, groupMode string, policyHash string, validPurchaseCount bigint, "
    "lines bigint, elapsedMillis bigint, counters map<string,bigint>"
)
_RECORD = (
    "schemaVersion int, variant string, effectiveVariant string, inputFingerprint string, groupMode string, "
    "policyHash string, startedAt string, warmup boolean, success boolean, error string, "
    "preprocessingMillis bigint, jobMillis bigint, endToEndMillis bigint, groups bigint, totalSumMinor bigint, "
    "counters map<string,bigint>, configuration map<string,string>"
)


#: Size and time by file.
Stamps = dict[str, tuple[int, datetime.datetime]]


@dataclass
class Preflight:
    files: list[InputFile]
    mode: GroupMode
    statistics: DataFrame  # a row per file; using it again scans the files again unless there is a tally
    manifest: DataFrame | None  # a row per file, stored; not made if a stored report vouches for the lines
    fingerprint: str
    lines: int
    valid_purchases: int
    errors: list[str] = field(default_factory=list)
    tallied: DataFrame | None = None  # outcomes, states and digests of the same scan, stored
    counters: dict[str, int] = field(default_factory=dict)  # lines per outcome
    content: str | None = None  # digest of the lines of that scan
    stamps: Stamps | None = None  # of the files before the first read

    @property
    def valid(self) -> bool:
        return not self.errors

    @property
    def file_states(self) -> DataFrame:
        """One state for each file and group."""
        valid = self.tallied.where(F.col("reason") == M.VALID_PURCHASE)
        return agg.merge_states(valid.select("uri", "group_key", "sum_minor", F.col("n").alias("purchase_count")), "uri", "group_key")

    @property
    def states(self) -> DataFrame:
        return agg.merge_states(self.file_states)


def run_preflight(
    spark: SparkSession,
    files: Sequence[InputFile],
    mode: GroupMode | str,
    max_errors: int = M.MAX_REPORTED_ERRORS,
    known: Row | None = None,
) -> Preflight:
    """Check and digest event files, in two reads: one for the digests of files, one for the lines.

    The scan that checks the lines also yields their digest, outcomes and group states. Offsets of
    broken lines are looked up only when there are any. ``known`` is the stored report of an earlier
    preflight: if the lines have the digest it states, they are the input of its fingerprint, and the
    files are not read for that again; ``manifest`` is missing then.
    """
    mode = GroupMode.of(mode)
    stamps = _stamps(spark, files)
    tallied = materialize(preflight.tally_files(spark, files, mode))
    statistics = preflight.statistics_of(tallied, files)
    totals = preflight.preflight_totals(statistics).first()
    counters, content = preflight.outcomes_of(tallied)
    digests, fingerprint = None, None
    if known is not None and known["contentDigest"] == content:
        fingerprint = known["inputFingerprint"]
    else:
        digests = materialize(manifest.file_manifest(spark, files))
        fingerprint = manifest.manifest_fingerprint(digests).first()["input_fingerprint"]
    errors: list[str] = []
    if totals["errors"]:
        located = preflight.line_violations(scan_lines(spark, files), mode)
        headless = preflight.rule_counts(statistics).where(F.col("rule") == preflight.NO_HEADER)
        # A missing header is reported at the end of its file.
        end = headless.select("uri", F.lit(2**62).alias("offset"), "rule")
        reported = preflight.first_errors(located.unionByName(end), max_errors)
        errors = [
            f"{r.rule}: {r.uri}" + ("" if r.rule == preflight.NO_HEADER else f"@{r.offset}") for r in reported.collect()
        ]
    lines, purchases = totals["lines"], totals["valid_purchases"]
    return Preflight(
        list(files), mode, statistics, digests, fingerprint, lines, purchases, errors, tallied, counters, content, stamps
    )


def manifest_entries(digests: DataFrame) -> DataFrame:
    """Digests as a manifest is stored: an object for each file."""
    return digests.select(
        F.lit(M.SCHEMA_VERSION).alias("schemaVersion"), F.lit(M.POLICY_HASH).alias("policyHash"), "uri", "bytes", "sha256"
    )


def write_preflight(checked: Preflight, manifest_path: str, report_path: str) -> None:
    """Publish the manifest and the report of a valid preflight."""
    if not checked.valid:
        raise RunFailed(f"The input breaks rules: {checked.errors}")
    spark = checked.manifest.sparkSession
    writers.ensure_new(spark, manifest_path)
    writers.ensure_new(spark, report_path)
    writers.write_artifact(manifest_entries(checked.manifest), manifest_path)
    report = spark.range(1).select(
        F.lit(M.SCHEMA_VERSION).alias("schemaVersion"),
        F.lit(checked.fingerprint).alias("inputFingerprint"),
        F.lit(checked.mode.value).alias("groupMode"),
        F.lit(checked.valid_purchases).alias("validPurchaseCount"),
        F.lit(checked.lines).alias("lines"),
        F.lit(checked.content).alias("contentDigest"),
        F.array().cast("array<string>").alias("errors"),
    )
    writers.write_artifact(report, report_path)


def files_of_manifest(spark: SparkSession, path: str) -> tuple[list[InputFile], DataFrame]:
    """The files a stored manifest names, and its entries."""
    entries = read_manifest(spark, path)
    return files_at(spark, entries), entries


def _unchanged(stored: DataFrame, current: DataFrame, max_errors: int = M.MAX_REPORTED_ERRORS) -> None:
    changed = manifest.input_drift(stored, current).orderBy("uri", "change").limit(max_errors).collect()
    if changed:
        raise RunFailed(f"The input is not the same any more: {[f'{r.change} {r.uri}' for r in changed]}")


def _stamps(spark: SparkSession, files: Sequence[InputFile]) -> Stamps:
    """Size and time of each file, as many entries as ``files`` has."""
    columns = manifest.file_stamps(spark, files).toArrow().to_pydict()
    return dict(zip(columns["uri"], zip(columns["bytes"], columns["modified"], strict=True), strict=True))


def _same_files(before: Stamps, spark: SparkSession, files: Sequence[InputFile]) -> None:
    """Sizes and times of the files are what they were before the first read."""
    now = _stamps(spark, files)
    _refuse(uri for uri in before.keys() | now.keys() if before.get(uri) != now.get(uri))


def _sizes_match(stored: DataFrame, stamps: Stamps) -> None:
    """The files have the names and sizes that a stored manifest lists."""
    listed = stored.select("uri", "bytes").toArrow().to_pydict()
    sizes = dict(zip(listed["uri"], listed["bytes"], strict=True))
    _refuse(uri for uri in sizes.keys() | stamps.keys() if uri not in stamps or stamps[uri][0] != sizes.get(uri))


def _refuse(changed: Iterable[str]) -> None:
    if names := sorted(changed)[: M.MAX_REPORTED_ERRORS]:
        raise RunFailed(f"The input is not the same any more: {names}")


def _matches_report(report: Row | None, checked: Preflight) -> None:
    """The stored preflight report speaks of this input, mode and number of purchases."""
    mine = (M.SCHEMA_VERSION, checked.fingerprint, checked.mode.value, checked.valid_purchases, checked.lines)
    if report is None or tuple(report)[:5] != mine or report.errors:
        raise RunFailed(f"The preflight report is of another input or mode: {report}, now {mine}")


@dataclass
class Profile:
    preflight: Preflight
    reasons: DataFrame
    groups: DataFrame
    dictionary: DataFrame
    elapsed_ms: int = 0


def run_profile(
    spark: SparkSession, files: Sequence[InputFile], mode: GroupMode | str, max_keys: int | None = None
) -> Profile:
    """Outcome counts, purchases per group and the group dictionary, from one pass over the lines.

    All of it belongs to the files as digested; if their sizes or times are others afterwards, the
    run fails.
    """
    began = time.monotonic()
    checked = run_preflight(spark, files, mode)
    if not checked.valid:
        raise RunFailed(f"The input breaks rules: {checked.errors}")
    reasons = checked.tallied.groupBy("reason").agg(F.sum("n").alias("n"))
    groups = materialize(checked.states.select("group_key", "purchase_count"))
    dictionary = materialize(dic.build_dictionary(groups, max_keys))
    _same_files(checked.stamps, spark, files)
    return Profile(checked, reasons, groups, dictionary, round((time.monotonic() - began) * 1000))


def write_profile(profiled: Profile, directory: str) -> None:
    """Publish the profile: a report of one object, and the purchases per group as JSON lines."""
    checked, spark = profiled.preflight, profiled.groups.sparkSession
    writers.ensure_new(spark, directory)
    staged = writers.staging_path(directory)
    counters = F.create_map(*(part for k, n in sorted(checked.counters.items()) for part in (F.lit(k), F.lit(n))))
    report = spark.range(1).select(
        F.lit(M.SCHEMA_VERSION).alias("schemaVersion"),
        F.lit(checked.fingerprint).alias("inputFingerprint"),
        F.lit(checked.mode.value).alias("groupMode"),
        F.lit(M.POLICY_HASH).alias("policyHash"),
        F.lit(checked.valid_purchases).cast("bigint").alias("validPurchaseCount"),
        F.lit(checked.lines).cast("bigint").alias("lines"),
        F.lit(profiled.elapsed_ms).cast("bigint").alias("elapsedMillis"),
        counters.alias("counters"),
    )
    try:
        writers.write_artifact(profiled.groups, f"{staged}/groups.json")
        writers.write_artifact(report, f"{staged}/profile.json")
        writers.publish(spark, staged, directory)
    finally:
        writers.discard(spark, staged)


def read_profiles(spark: SparkSession, directories: Sequence[str]) -> DataFrame:
    """The reports of stored profiles, a row each."""
    return spark.read.schema(_PROFILE).json([f"{d.rstrip('/')}/profile.json" for d in directories])


#: Most groups of a dictionary that is published as one object.
MAX_OBJECT_KEYS = 100_000


def write_dictionary(profiled: Profile, path: str) -> None:
    """Publish the dictionary as a folder: entries as JSON lines in id order, spread over files, and a head.

    The head has provenance, number of groups and the digest over all entries, which tasks add up.
    """
    spark, mode = profiled.dictionary.sparkSession, profiled.preflight.mode
    writers.ensure_new(spark, path)
    staged = writers.staging_path(path)
    head = dic.dictionary_digest(profiled.dictionary, F.lit(profiled.preflight.fingerprint), mode).select(
        F.lit(M.SCHEMA_VERSION).alias("schemaVersion"),
        F.col("input_fingerprint").alias("inputFingerprint"),
        F.col("group_mode").alias("groupMode"),
        F.col("policy_hash").alias("policyHash"),
        "groups",
        "digest",
    )
    entries = profiled.dictionary.repartitionByRange("id").sortWithinPartitions("id")
    try:
        writers.write_artifact(entries.select("id", F.col("group_key").alias("group")), f"{staged}/entries.json")
        writers.write_artifact(head.coalesce(1), f"{staged}/head.json")
        writers.publish(spark, staged, path)
    finally:
        writers.discard(spark, staged)


def write_dictionary_object(profiled: Profile, path: str) -> None:
    """Publish a dictionary of at most a hundred thousand groups as one JSON object, with the checksum of its one text."""
    dic.guarded(profiled.dictionary, MAX_OBJECT_KEYS)
    fingerprint = F.lit(profiled.preflight.fingerprint)
    head = dic.dictionary_checksum(profiled.dictionary, fingerprint, profiled.preflight.mode).first()
    gathered = profiled.dictionary.agg(F.array_sort(F.collect_list(F.struct("id", "group_key"))).alias("entries"))
    row = gathered.select(
        F.lit(M.SCHEMA_VERSION).alias("schemaVersion"),
        F.lit(head["input_fingerprint"]).alias("inputFingerprint"),
        F.lit(head["group_mode"]).alias("groupMode"),
        F.lit(head["policy_hash"]).alias("policyHash"),
        F.lit(head["checksum"]).alias("checksum"),
        F.col("entries.group_key").alias("groups"),
    )
    writers.write_artifact(row, path)


def check_dictionary(stored: DataFrame, fingerprint: str, mode: GroupMode | str) -> DataFrame:
    """``id, group_key`` of a stored dictionary that belongs to this input and is undamaged."""
    mode = GroupMode.of(mode)
    rows = stored.select("id", "group_key")
    by_object = "checksum" in stored.columns
    provenance = ("input_fingerprint", "group_mode", "policy_hash", "checksum" if by_object else "digest")
    head = stored.select(*provenance).distinct().limit(2).collect()
    if head:
        recompute = dic.dictionary_checksum if by_object else dic.dictionary_digest
        recomputed = recompute(rows, F.lit(fingerprint), mode).first()
        if len(head) > 1 or any(head[0][c] != recomputed[c] for c in provenance):
            raise RunFailed("The dictionary is of another input or damaged")
    if not dic.dictionary_violations(rows).isEmpty():
        raise RunFailed("The dictionary breaks rules of its keys or their order")
    return rows


def run_aggregate(
    spark: SparkSession,
    files: Sequence[InputFile],
    output: str,
    mode: GroupMode | str = GroupMode.CATEGORY_ID,
    strategy: str = "partial",
    dictionary: DataFrame | None = None,
    stored_manifest: DataFrame | None = None,
    stored_report: str | None = None,
    max_keys: int | None = None,
    warmup: bool = False,
    failed_record: str | None = None,
) -> dict:
    """Aggregate event files into a new result table and return the run record.

    Published only if the input passes preflight and matches its manifest and preflight report (if
    given), no damaged line turned up, the written result validates and adds up to the counted
    purchases, and the files have the same sizes and times afterwards. Otherwise :class:`RunFailed` is
    raised and the target does not exist; the record of the failed run is written to ``failed_record``.

    Counters, states and the digest of the lines come from one scan. The files are read once more for
    their published digests, unless the stored report knows the lines by their digest already.
    """
    began, started = time.monotonic(), datetime.datetime.now(datetime.timezone.utc)
    record = {
        "schemaVersion": 3,
        "variant": strategy,
        "effectiveVariant": agg.VARIANTS.get(strategy, strategy),
        "groupMode": GroupMode.of(mode).value,
        "policyHash": M.POLICY_HASH,
        "startedAt": started.isoformat(),
        "warmup": warmup,
        "success": False,
        "configuration": {"spark.version": spark.version, "spark.master": spark.sparkContext.master},
    }
    writers.ensure_new(spark, output)
    writers.ensure_apart(spark, output, *(f.uri for f in files))
    staged = writers.staging_path(output)
    try:
        report = read_artifact(spark, stored_report, _REPORT).first() if stored_report is not None else None
        checked = run_preflight(spark, files, mode, known=report)
        record |= {"inputFingerprint": checked.fingerprint, "preprocessingMillis": _since(began)}
        record |= {"counters": checked.counters}
        if not checked.valid:
            raise RunFailed(f"The input breaks rules: {checked.errors}")
        if stored_manifest is not None:
            if checked.manifest is None:
                _sizes_match(stored_manifest, checked.stamps)
            else:
                _unchanged(stored_manifest, checked.manifest)
        if stored_report is not None:
            _matches_report(report, checked)
        if dictionary is not None and {"checksum", "digest"} & set(dictionary.columns):
            dictionary = check_dictionary(dictionary, checked.fingerprint, mode)
        if checked.counters.get(M.MALFORMED_CSV, 0):
            raise RunFailed("Lines turned out malformed during the run")
        preflighted = time.monotonic()
        writers.stage_result(agg.route_states(checked.file_states, strategy, dictionary, "uri"), staged)
        record["jobMillis"] = _since(preflighted)
        checks = compare.validate_result(
            parse_result_lines(read_result_lines(spark, staged)), checked.valid_purchases, max_keys
        ).first()
        record |= {"groups": checks["group_count"], "totalSumMinor": checks["total_sum_minor"]}
        counted = checked.counters.get(M.VALID_PURCHASE, 0)
        if checks["too_many_groups"]:
            raise RunFailed(f"The result has {checks['group_count']} groups, more than {max_keys}")
        if not checks["valid"] or counted != checked.valid_purchases:
            raise RunFailed(f"Sums or counts differ: {checks.asDict()}, counted {counted}")
        _same_files(checked.stamps, spark, files)
        record |= {"success": True, "endToEndMillis": _since(began)}
        writers.write_artifact(_record_row(spark, record), f"{staged}/_run-manifest.json")
        writers.publish(spark, staged, output)
    except Exception as error:
        if failed_record is not None:
            failed = record | {"success": False, "error": str(error)[:4000], "endToEndMillis": _since(began)}
            writers.write_artifact(_record_row(spark, failed), failed_record)
        raise
    finally:
        writers.discard(spark, staged)
    return record


def _since(began: float) -> int:
    return round((time.monotonic() - began) * 1000)


def _record_row(spark: SparkSession, record: dict) -> DataFrame:
    return spark.createDataFrame([record], _RECORD).coalesce(1)


def read_records(spark: SparkSession, paths: Sequence[str], profiles: DataFrame | None = None) -> DataFrame:
    """Stored run records in the shape that :func:`tillroll.operators.summary.run_summary` takes.

    Routes with a dictionary cost a profile; its time comes from the profile of the same input,
    mode and policy (the fastest, if there are several), and is missing without one. What a run
    does not record (bytes and records of shuffles) is null.
    """
    records = spark.read.schema(_RECORD).json([f"{p.rstrip('/')}" for p in paths])
    keys = ["inputFingerprint", "groupMode", "policyHash"]
    if profiles is None:
        profiles = spark.createDataFrame([], _PROFILE)
    cost = profiles.groupBy(*keys).agg(F.min("elapsedMillis").alias("profiled"))
    needs = F.col("effectiveVariant").isin("dictionary", "packed")
    return records.join(cost, keys, "left").select(
        "variant",
        F.col("effectiveVariant").alias("effective_variant"),
        "success",
        "warmup",
        F.col("jobMillis").alias("job_ms"),
        F.col("endToEndMillis").alias("end_to_end_ms"),
        F.when(needs, F.col("profiled")).otherwise(F.lit(0)).alias("profile_ms"),
        *(F.lit(None).cast("bigint").alias(c) for c in ("shuffle_bytes", "map_records", "reduce_records")),
        "groups",
        F.col("totalSumMinor").alias("total_sum_minor"),
        F.element_at("counters", F.lit(M.VALID_PURCHASE)).alias("purchases"),
        F.element_at("counters", F.lit(M.MALFORMED_CSV)).alias("malformed"),
        "error",
    )


def run_sample(
    spark: SparkSession, files: Sequence[InputFile], stored_manifest: DataFrame, directory: str, rate: float,
    seed: int = DEFAULT_SEED, mode: GroupMode | str = GroupMode.CATEGORY_ID,
) -> Preflight:
    """Write a deterministic sample of the lines, then its manifest, preflight and provenance.

    The sample is renamed to its place and checked there, since a manifest names files by their
    place. If anything fails after that, all of it is taken away again.
    """
    sample.sample_threshold(rate)
    extras = [f"{directory}.{name}.json" for name in ("manifest", "preflight", "sample")]
    for path in (directory, *extras):
        writers.ensure_new(spark, path)
    source = run_preflight(spark, files, mode)
    if not source.valid:
        raise RunFailed(f"The input breaks rules: {source.errors}")
    _unchanged(stored_manifest, source.manifest)
    lines = parse_event_lines(scan_lines(spark, files))
    kept = sample.hash_sample(lines.where(F.col("kind") != M.KIND_HEADER), rate, seed)
    staged = writers.staging_path(directory)
    try:
        writers.write_sample(kept, staged)
        _same_files(source.stamps, spark, files)
        writers.publish(spark, staged, directory)
    finally:
        writers.discard(spark, staged)
    try:
        sampled = run_preflight(spark, list_csv(spark, directory), mode)
        write_preflight(sampled, extras[0], extras[1])
        provenance = spark.range(1).select(
            F.lit(source.fingerprint).alias("sourceFingerprint"),
            F.lit(float(rate)).alias("rate"),
            F.lit(seed).cast("bigint").alias("seed"),
            F.lit(sampled.fingerprint).alias("sampleFingerprint"),
        )
        writers.write_artifact(provenance, extras[2])
    except Exception:
        for path in (directory, *extras):
            writers.discard(spark, path)
        raise
    return sampled


def read_result(spark: SparkSession, directory: str) -> DataFrame:
    """A valid result table; a broken rule or repeated key fails."""
    parsed = parse_result_lines(read_result_lines(spark, directory))
    broken = compare.result_violations(parsed).orderBy("violation", "group_key").limit(M.MAX_REPORTED_ERRORS).collect()
    if broken:
        raise RunFailed(f"The result breaks rules: {[f'{r.violation} {r.group_key}' for r in broken]}")
    return parsed.drop("value", "violation")


def run_compare(spark: SparkSession, left: str, right: str) -> DataFrame:
    """The differing groups of two result tables; empty when they are equal."""
    return compare.result_diff(read_result(spark, left), read_result(spark, right))


def run_export(spark: SparkSession, result: str, path: str, single: bool = False) -> None:
    """A result table as CSV in key order: part files of a folder, or a ``single`` file."""
    writers.export_csv(read_result(spark, result), path, single)
