"""Table sinks: full refresh (K1), keyed upsert into versioned Parquet (K2),
stored check failures by run (K3), and explicit-schema readers for raw sources (S1-S7).

Plain Parquet has no MERGE, so an upsert writes a complete new version
directory (``<table>/version=000042``) and readers take the newest version
that finished (has ``_SUCCESS``).  A failed or half-written job therefore
never corrupts the current version, and a retried job simply writes the next
version.  All paths go through the Hadoop FileSystem of the path, so the
same code runs on HDFS, object stores or a local disk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION_PREFIX = "version="


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, table: str) -> list[int]:
    """Completed versions of a table, oldest first."""
    fs, root = _fs(spark, table)
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(VERSION_PREFIX):
            success = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
            if fs.exists(success):
                out.append(int(name[len(VERSION_PREFIX):]))
    return sorted(out)


def current_path(spark: SparkSession, table: str) -> str | None:
    v = versions(spark, table)
    return f"{table}/{VERSION_PREFIX}{v[-1]:06d}" if v else None


def read_current(spark: SparkSession, table: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """The table's newest completed version, or None for a first run."""
    path = current_path(spark, table)
    if path is None:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def write_version(df: DataFrame, table: str, partition_by: list[str] | None = None) -> str:
    """K1: write ``df`` as the next version of ``table`` and return its path."""
    spark = df.sparkSession
    v = versions(spark, table)
    path = f"{table}/{VERSION_PREFIX}{(v[-1] + 1 if v else 1):06d}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def upsert_frame(target: DataFrame | None, new: DataFrame, key: str) -> DataFrame:
    """K2 as a plan: target rows whose key is not in ``new``, plus ``new``.

    The anti join reads only the key column of ``new``; the distinct on it is
    a map-side-combined aggregate.
    """
    if target is None:
        return new
    keys = new.select(key).distinct()
    return target.join(keys, key, "left_anti").unionByName(new.select(*target.columns))


def replace_groups(target: DataFrame | None, new: DataFrame, key: str,
                   touched_keys: DataFrame) -> DataFrame:
    """Upsert that also deletes target rows of ``touched_keys`` absent from ``new``."""
    if target is None:
        return new
    kept = target.join(touched_keys.select(key).distinct(), key, "left_anti")
    return kept.unionByName(new.select(*target.columns))


def upsert(new: DataFrame, table: str, key: str) -> str:
    """K2: merge ``new`` into the current version by ``key``; write the next version."""
    spark = new.sparkSession
    target = read_current(spark, table)
    return write_version(upsert_frame(target, new, key), table)


def failure_rows(failures: DataFrame, check_name: str) -> DataFrame:
    """K3: a check's failing rows as ``(check, row)``, the row as JSON."""
    return failures.select(F.lit(check_name).alias("check"), F.to_json(F.struct("*")).alias("row"))


def row_failure_rows(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """K3 for all row checks of a model in one pass: a row that fails n checks gives n rows."""
    names = F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in predicates.items()]),
                     lambda name: name.isNotNull())
    return df.select(F.explode(names).alias("check"), F.to_json(
        F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("row"))


def store_failures(rows: DataFrame, path: str, run_id: str, part: str) -> None:
    """K3: store failing rows by run, part of the run and check.  A repeat of the run replaces
    them all, also those of checks that no longer fail."""
    (rows.withColumn("stored_at", F.current_timestamp())
     .write.mode("overwrite").partitionBy("check").parquet(f"{path}/run_id={run_id}/part={part}"))


# --------------------------------------------------------------- raw readers
def _schema(fields: str) -> str:
    # DDL text: accepted by ``DataFrameReader.schema`` and needs no live session.
    return fields


# Raw source schemas (explicit; no inference).
CASE_SCHEMA = _schema(
    "id BIGINT, beneficiary_id BIGINT, catalog_product_id STRING, flow_template_id BIGINT, "
    "flow_template_version_id BIGINT, stage STRING, status STRING, stage_instance_id BIGINT, "
    "kickoff_date DATE, classification_date DATE, filing_date_actual DATE, receipt_date DATE, "
    "decision_date DATE, initialized_at TIMESTAMP, case_matter_case_id BIGINT, "
    "created_at TIMESTAMP, updated_at TIMESTAMP, deleted_at TIMESTAMP, ingestion_timestamp TIMESTAMP")
TASK_SCHEMA = _schema(
    "id BIGINT, case_id BIGINT, name STRING, description STRING, task_template_id BIGINT, "
    "creation_source STRING, case_stage_scope STRING, sub_stage STRING, status STRING, "
    "blocked_reason STRING, force_unblocked BOOLEAN, activation_ts TIMESTAMP, "
    "completion_ts TIMESTAMP, created_at TIMESTAMP, updated_at TIMESTAMP, deleted_at TIMESTAMP, "
    "ingestion_timestamp TIMESTAMP")
ASSIGNMENT_SCHEMA = _schema(
    "id BIGINT, task_id BIGINT, role_binding STRING, role STRING, action STRING, status STRING, "
    "iteration_count BIGINT, active_time_ms BIGINT, auto_activate BOOLEAN, activated_ts TIMESTAMP, "
    "submitted_ts TIMESTAMP, completed_ts TIMESTAMP, created_at TIMESTAMP, updated_at TIMESTAMP, "
    "deleted_at TIMESTAMP, ingestion_timestamp TIMESTAMP")
EVENT_SCHEMA = _schema(
    "event_time STRING, ingestion_timestamp STRING, event_type STRING, event_properties STRING")
PREDECESSOR_SCHEMA = _schema(
    "task_id BIGINT, predecessor_task_id BIGINT, ingestion_timestamp TIMESTAMP")

LEGACY_CASE_SCHEMA = _schema(
    "id BIGINT, beneficiary_id BIGINT, product_id STRING, status STRING, created_at TIMESTAMP, "
    "ingestion_timestamp TIMESTAMP")
LEGACY_DOCUMENT_SCHEMA = _schema(
    "id BIGINT, evidence_id BIGINT, status STRING, uploaded_by_case_role STRING, "
    "iteration_count BIGINT, created_at TIMESTAMP, ingestion_timestamp TIMESTAMP")
LEGACY_PROPERTY_SCHEMA = _schema(
    "id BIGINT, evidence_id BIGINT, property_type STRING, created_at TIMESTAMP, "
    "ingestion_timestamp TIMESTAMP")
LEGACY_RECOMMENDER_SCHEMA = _schema(
    "id BIGINT, case_id BIGINT, status STRING, created_at TIMESTAMP, ingestion_timestamp TIMESTAMP")

RAW_SCHEMAS = {"cw_case": CASE_SCHEMA, "cw_task": TASK_SCHEMA,
               "cw_task_assignment": ASSIGNMENT_SCHEMA, "events": EVENT_SCHEMA,
               "cw_task_predecessor": PREDECESSOR_SCHEMA, "cm_case": LEGACY_CASE_SCHEMA,
               "cm_evidence_document": LEGACY_DOCUMENT_SCHEMA,
               "cm_evidence_property": LEGACY_PROPERTY_SCHEMA,
               "cm_recommender": LEGACY_RECOMMENDER_SCHEMA}

#: The raw source behind each frame name of the models and checks.
SOURCE_OF_FRAME = {"wf_case": "cw_case", "wf_task": "cw_task", "wf_assignment": "cw_task_assignment",
                   "wf_events": "events", "wf_task_predecessor": "cw_task_predecessor",
                   "cm_case": "cm_case", "cm_evidence_document": "cm_evidence_document",
                   "cm_evidence_property": "cm_evidence_property", "cm_recommender": "cm_recommender"}


def read_raw(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
             options: dict[str, str] | None = None) -> DataFrame:
    """Read a raw source with its declared schema (parquet, json, csv, jdbc...)."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt != "jdbc":
        reader = reader.schema(RAW_SCHEMAS[name])
        return reader.load(path)
    return reader.load()


def stream_raw_events(spark: SparkSession, path: str, fmt: str = "parquet",
                      options: dict[str, str] | None = None) -> DataFrame:
    """S4 streaming variant: the raw event feed as an unbounded file source."""
    return (spark.readStream.format(fmt).schema(EVENT_SCHEMA)
            .options(**(options or {})).load(path))


class RawTables:
    """The raw sources of a deployment, by frame name.

    A source that is not given is an empty table with its declared schema, so the freshness
    and volume checks report it.
    """

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame]):
        unknown = set(frames) - set(SOURCE_OF_FRAME)
        if unknown:
            raise KeyError(f"unknown raw sources: {', '.join(sorted(unknown))}")
        self.spark = spark
        self._frames = {name: frames[name] if name in frames
                        else spark.createDataFrame([], RAW_SCHEMAS[source])
                        for name, source in SOURCE_OF_FRAME.items()}

    @classmethod
    def read(cls, spark: SparkSession, paths: dict[str, str], fmt: str = "parquet",
             options: dict[str, str] | None = None) -> "RawTables":
        """Read sources by their raw name (``cw_case``, ``events``, ...) with declared schemas."""
        frame_of = {source: name for name, source in SOURCE_OF_FRAME.items()}
        return cls(spark, {frame_of[source]: read_raw(spark, source, path, fmt, options)
                           for source, path in paths.items()})

    def frames(self) -> dict[str, DataFrame]:
        return dict(self._frames)
