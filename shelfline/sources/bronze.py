"""Landing of the four sources behind their gates, with audit records."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import files
from shelfline.operators.frames import enrich_metadata
from shelfline.sources import commits, schemas
from shelfline.sources.readers import read_csv
from shelfline.sources.writers import add_months, audit_row, observed


@dataclass(frozen=True)
class Source:
    """A landed feed: its schema, the keys that may not be null, and how its table is laid out."""

    name: str
    system: str
    schema: T.StructType
    gate: tuple[str, ...]
    publish: Callable[..., None]


def _by(column: str) -> Callable[..., None]:
    return lambda df, path, check: commits.write(df, path, [column], check=check)


# Run order, source systems and gated keys.
SOURCES = (
    Source("pos", "POS", schemas.POS, ("transaction_id", "customer_id", "product_id"), add_months),
    Source("ecommerce", "ECOMMERCE", schemas.ECOMMERCE, (), add_months),
    Source("erp", "ERP", schemas.ERP, ("product_id", "store_id", "snapshot_date"), _by("snapshot_date")),
    Source("external", "EXTERNAL", schemas.EXTERNAL, (), _by("date")),
)


class NullKeyError(ValueError):
    """Rows arrived without a key."""


def land(spark: SparkSession, source: Source, landed: str, table: str) -> int:
    """Read, stamp, write and count in one pass; the commit follows only when no key is missing. Returns the row count."""
    df = enrich_metadata(read_csv(spark, landed, source.schema), source.system)
    missing = F.lit(False)
    for key in source.gate:
        missing = missing | F.col(key).isNull()
    counted, seen = observed(df, source.name, n_rows=F.count(F.lit(1)), n_bad=F.count_if(missing))

    def gate() -> None:
        if seen.get["n_bad"]:
            raise NullKeyError(f"{source.name}: {seen.get['n_bad']} rows without {', '.join(source.gate)}")

    source.publish(counted, table, check=gate)
    return seen.get["n_rows"]


def ingest_all(spark: SparkSession, landed: dict[str, str], tables: str, audit: str) -> DataFrame:
    """Land every source in order; a missing path is skipped and one failure does not stop the rest."""
    outcome = []
    for source in SOURCES:
        path, table = landed.get(source.name), f"{tables}/{source.name}"
        if path is None or not files.exists(spark, path):
            outcome.append((source.name, "SKIPPED", None))
            continue
        run = uuid.uuid4().hex
        audit_row(spark, audit, f"ingest_{source.name}", "START", run, [path], [table])
        try:
            rows = land(spark, source, path, table)
        except Exception as error:
            audit_row(spark, audit, f"ingest_{source.name}", "FAIL", run, [path], [table], message=str(error))
            outcome.append((source.name, f"FAILED: {error}", None))
            continue
        audit_row(spark, audit, f"ingest_{source.name}", "COMPLETE", run, [path], [table], rows, source.schema.names)
        outcome.append((source.name, "SUCCESS", rows))
    return spark.createDataFrame(outcome, "source string, status string, row_count long")
