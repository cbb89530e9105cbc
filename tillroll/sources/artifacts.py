"""Reading JSON artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.model import POLICY_HASH, SCHEMA_VERSION
from tillroll.session import fail_if
from tillroll.sources.files import InputError, hadoop_path

_MANIFEST = (
    "schemaVersion int, policyHash string, files array<struct<uri:string, bytes:bigint, sha256:string>>, "
    "uri string, bytes bigint, sha256 string"
)
_DICTIONARY = (
    "schemaVersion int, inputFingerprint string, groupMode string, policyHash string, checksum string, "
    "groups array<string>"
)


def read_artifact(
    spark: SparkSession, path: str, schema: str | None = None, max_bytes: int | None = None
) -> DataFrame:
    """One JSON object per file; with ``max_bytes`` set, no file may be larger."""
    jpath, fs = hadoop_path(spark, path)
    if not fs.exists(jpath):
        raise InputError(f"There is no artifact at {path}")
    status = fs.getFileStatus(jpath)
    statuses = [status] if status.isFile() else [s for s in fs.listStatus(jpath) if s.isFile()]
    if max_bytes is not None and any(s.getLen() > max_bytes for s in statuses):
        raise InputError(f"A file of {path} has more than {max_bytes} bytes")
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path, multiLine=True)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``uri, bytes, sha256`` from one object with a file list, or from a JSON-lines folder."""
    jpath, fs = hadoop_path(spark, path)
    if fs.exists(jpath) and fs.getFileStatus(jpath).isDirectory():
        rows = spark.read.schema(_MANIFEST).json(path)
    else:
        nested = read_artifact(spark, path, _MANIFEST).select("schemaVersion", "policyHash", F.inline("files"))
        rows = nested
    stale = ~F.col("schemaVersion").eqNullSafe(SCHEMA_VERSION) | ~F.col("policyHash").eqNullSafe(POLICY_HASH)
    uri = fail_if(stale, "Invalid manifest schema or policy", F.col("uri"))
    return rows.select(uri.alias("uri"), "bytes", "sha256")


_HEAD = "schemaVersion int, inputFingerprint string, groupMode string, policyHash string, groups bigint, digest string"


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``id, group_key`` plus the provenance columns: ``digest`` from a dictionary folder, ``checksum`` from one object."""
    jpath, fs = hadoop_path(spark, f"{path.rstrip('/')}/head.json")
    if fs.exists(jpath):
        head = spark.read.schema(_HEAD).json(f"{path.rstrip('/')}/head.json").first()
        if head is None:
            raise InputError(f"The dictionary at {path} has no head")
        entries = spark.read.schema("id bigint, group string").json(f"{path.rstrip('/')}/entries.json")
        return entries.select(
            "id",
            F.col("group").alias("group_key"),
            F.lit(head["inputFingerprint"]).alias("input_fingerprint"),
            F.lit(head["groupMode"]).alias("group_mode"),
            F.lit(head["policyHash"]).alias("policy_hash"),
            F.lit(head["digest"]).alias("digest"),
        )
    return read_artifact(spark, path, _DICTIONARY).select(
        F.posexplode("groups").alias("id", "group_key"),
        F.col("inputFingerprint").alias("input_fingerprint"),
        F.col("groupMode").alias("group_mode"),
        F.col("policyHash").alias("policy_hash"),
        "checksum",
    )
