"""Target tables: columns, keys and the column that decides which copy is newest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

Columns = tuple[tuple[str, str], ...]

# Column names, types and keys of the target tables.
_CRM_HEAD: Columns = (
    ("id", "STRING"), ("created_at", "TIMESTAMP"), ("updated_at", "TIMESTAMP"),
    ("archived", "BOOLEAN"), ("archived_at", "TIMESTAMP"),
)
_WORKSPACE_HEAD: Columns = (
    ("id", "STRING"), ("created_time", "TIMESTAMP"), ("last_edited_time", "TIMESTAMP"),
    ("created_by_id", "STRING"), ("last_edited_by_id", "STRING"), ("in_trash", "BOOLEAN"),
    ("parent_type", "STRING"), ("parent_id", "STRING"),
)
_TAIL: Columns = (("raw_json", "STRING"), ("_ingested_at", "TIMESTAMP"))


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: Columns
    key: tuple[str, ...]
    order_by: str
    parent: str | None = None  # rows are replaced per parent when set

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{name}` {kind}" for name, kind in self.columns)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def bucket_by(self) -> tuple[str, ...]:
        """Columns that decide the storage bucket, so one change touches one bucket."""
        return (self.parent,) if self.parent else self.key


ISSUES = TableSpec(
    "issues",
    tuple((c, "STRING") for c in ("key", "summary", "status", "priority", "assignee",
                                  "reporter", "issuetype", "project"))
    + (("created", "TIMESTAMP"), ("updated", "TIMESTAMP"), ("raw_fields", "STRING")),
    key=("key",), order_by="updated",
)
CONTACTS = TableSpec(
    "contacts",
    _CRM_HEAD + tuple((c, "STRING") for c in ("email", "first_name", "last_name", "phone",
                                              "lifecycle_stage")) + _TAIL,
    key=("id",), order_by="updated_at",
)
COMPANIES = TableSpec(
    "companies",
    _CRM_HEAD + tuple((c, "STRING") for c in ("name", "domain", "industry")) + _TAIL,
    key=("id",), order_by="updated_at",
)
DEALS = TableSpec(
    "deals",
    _CRM_HEAD + (("deal_name", "STRING"), ("amount", "DECIMAL(38,6)"), ("currency", "STRING"),
                 ("deal_stage", "STRING"), ("pipeline", "STRING"), ("close_date", "TIMESTAMP"),
                 ("owner_id", "STRING")) + _TAIL,
    key=("id",), order_by="updated_at",
)
ASSOCIATIONS = TableSpec(
    "associations",
    (("from_object", "STRING"), ("from_id", "STRING"), ("to_object", "STRING"), ("to_id", "STRING"),
     ("association_type_id", "INT"), ("category", "STRING"), ("label", "STRING"),
     ("_ingested_at", "TIMESTAMP")),
    key=("from_object", "from_id", "to_object", "to_id", "association_type_id"),
    order_by="_ingested_at",
)
PAGES = TableSpec(
    "pages", _WORKSPACE_HEAD + (("url", "STRING"), ("public_url", "STRING"), ("title", "STRING")) + _TAIL,
    key=("id",), order_by="last_edited_time",
)
DATA_SOURCES = TableSpec(
    "data_sources", _WORKSPACE_HEAD + (("url", "STRING"), ("title", "STRING")) + _TAIL,
    key=("id",), order_by="last_edited_time",
)
BLOCKS = TableSpec(
    "blocks",
    _WORKSPACE_HEAD + (("type", "STRING"), ("has_children", "BOOLEAN"), ("page_id", "STRING"),
                       ("depth", "INT"), ("position", "INT")) + _TAIL,
    key=("page_id", "id"), order_by="last_edited_time", parent="page_id",
)
USERS = TableSpec(
    "users",
    tuple((c, "STRING") for c in ("id", "type", "name", "avatar_url", "email")) + _TAIL,
    key=("id",), order_by="_ingested_at",
)
_STATE: Columns = (
    ("object_name", "STRING"), ("watermark", "TIMESTAMP"), ("last_mode", "STRING"),
    ("last_status", "STRING"), ("last_rows", "BIGINT"), ("last_run_at", "TIMESTAMP"),
)
CRM_STATE = TableSpec("crm_sync_state", _STATE, key=("object_name",), order_by="last_run_at")
WORKSPACE_STATE = TableSpec(
    "workspace_sync_state", _STATE + (("last_error", "STRING"),), key=("object_name",), order_by="last_run_at",
)
CRM_TABLES = {t.name: t for t in (CONTACTS, COMPANIES, DEALS)}
WORKSPACE_TABLES = {t.name: t for t in (USERS, DATA_SOURCES, PAGES, BLOCKS)}
