"""Load settings of one table, as the jobs need them on the driver."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Row

from lakeload.operators.registry import DEFAULT_BRONZE_SCHEMA, DEFAULT_LOAD_MODE, DEFAULT_SILVER_SCHEMA
from lakeload.sources.bronze import DEFAULT_WINDOW_COLUMN, MONTH_COLUMN, YEAR_COLUMN, FileShape


@dataclass(frozen=True)
class TableSpec:
    name: str
    load_mode: str = DEFAULT_LOAD_MODE
    bronze_table: str = ""
    silver_table: str = ""
    business_keys: tuple[str, ...] = ()
    incremental_column: str | None = None
    window_column: str = DEFAULT_WINDOW_COLUMN
    by_month: bool = False
    year_column: str = YEAR_COLUMN
    month_column: str = MONTH_COLUMN
    sync_deletes: bool = False
    shape: FileShape = field(default_factory=FileShape)

    def __post_init__(self):
        if not self.name:
            raise ValueError("a table needs a name")
        if not self.bronze_table:
            object.__setattr__(self, "bronze_table", f"{DEFAULT_BRONZE_SCHEMA}.{self.name}")
        if not self.silver_table:
            object.__setattr__(self, "silver_table", f"{DEFAULT_SILVER_SCHEMA}.{self.name}")

    @classmethod
    def from_row(cls, row: Row) -> TableSpec:
        """From a registry row that went through ``with_targets``."""
        r = row.asDict(recursive=True)
        parts = r.get("partitioning") or {}
        return cls(
            name=r["name"],
            load_mode=(r.get("load_mode") or DEFAULT_LOAD_MODE).lower(),
            bronze_table=r["bronze_table"],
            silver_table=r["silver_table"],
            business_keys=tuple(r.get("business_keys") or ()),
            incremental_column=r.get("incremental_column"),
            window_column=r.get("window_column") or DEFAULT_WINDOW_COLUMN,
            by_month=parts.get("type") == "year_month",
            year_column=parts.get("year_col") or YEAR_COLUMN,
            month_column=parts.get("month_col") or MONTH_COLUMN,
            sync_deletes=bool(r.get("sync_deletes")),
            shape=FileShape(
                single_file=bool(r.get("single_file")),
                max_rows_per_file=r.get("max_rows_per_file"),
                zorder_by=tuple(r.get("zorder") or ())))
