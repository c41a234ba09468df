"""Configuration objects and the few session settings the operators rely on."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# Data models a record may be routed with.
DM_TYPE_DATABASE = "dm-by-entity-type-database"
DM_TYPE_SCHEMA = "dm-by-entity-type-database-schema"
DM_FIXED_TYPE_SCHEMA = "dm-by-fixed-entity-type-database-schema"
DM_SQL_ERRORS = "dm-postgis-errors"
DM_HTTP_ERRORS = "dm-http-errors"

# The six input flows.
FLOWS = ("historic", "lastdata", "mutable", "mongo", "sgtr", "errors")

SESSION_SETTINGS = {
    # Timestamps without an offset are UTC.
    "spark.sql.session.timeZone": "UTC",
    # Attributes that differ only by case: the later one wins, at the place of the first.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # The same for names that occur twice in a nested value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for name, value in SESSION_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and stream state.

    This is the folder named in ``spark.checkpoint.dir``; where that is unset, a folder in the session's
    warehouse, which all executors share as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return shared.rstrip("/") if shared else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


@dataclass(frozen=True)
class FlowConfig:
    """Settings of the relational, document and error flows."""

    prefix: str = ""
    suffix: str = ""
    datamodel: str | None = None
    schema_override: str | None = None
    # Static table suffix; None takes the suffix of the record (historic has none).
    table_suffix: str | None = None
    # Routing field (service, servicepath, entitytype, datamodel, suffix) -> header name or literal.
    fields: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class GraphConfig:
    """Settings of the graph mutation flow."""

    prefix: str = ""
    suffix: str = ""
    fallback_to_service: bool = False
    topic_by_service: bool = False
    staging: bool = False
    slug_uri: bool = False
    # Base of the resource addresses in delete mutations; without one they are refused.
    resource_base: str | None = None
