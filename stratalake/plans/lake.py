"""Where a lake lives: landing folder, catalog and schema names."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from stratalake.sinks.tables import PLAIN, TableLayout, ensure_schema
from stratalake.sources.landing import BATCH_FOLDER

TIERS = ("bronze", "silver", "gold", "control")


@dataclass(frozen=True)
class Lake:
    """Schemas are named ``<prefix><tier>``; with ``location`` each gets a folder below it.

    ``layouts`` gives silver and gold tables, named like ``"silver.drivers"``, another
    physical layout than the default when they are created: a very large table is
    best bucketed by its key.  ``batch_pattern`` says which landing folders are batches.
    """

    spark: SparkSession
    landing: str
    prefix: str = ""
    location: str | None = None
    catalog: str = "spark_catalog"
    layouts: Mapping[str, TableLayout] = field(default_factory=dict)
    batch_pattern: str = BATCH_FOLDER

    def schema(self, tier: str) -> str:
        return f"{self.catalog}.{self.prefix}{tier}"

    def name(self, tier: str, table: str) -> str:
        return f"{self.schema(tier)}.{table}"

    def table(self, tier: str, table: str) -> DataFrame:
        return self.spark.table(self.name(tier, table))

    def layout(self, tier: str, table: str, default: TableLayout = PLAIN) -> TableLayout:
        return self.layouts.get(f"{tier}.{table}", default)

    @property
    def control_table(self) -> str:
        return self.name("control", "batch_control")

    @property
    def audit_table(self) -> str:
        return self.name("control", "load_audit")

    def create_schemas(self) -> None:
        for tier in TIERS:
            folder = f"{self.location.rstrip('/')}/{tier}" if self.location else None
            ensure_schema(self.spark, self.schema(tier), folder)
