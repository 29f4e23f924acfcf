"""Data exchange on Spark: scan, infer, load, export, split, run SQL, change tables."""

from quayside.operators.dml import DmlResult, MergeClause, delete, merge, update
from quayside.operators.export import ExportResult, export, export_json
from quayside.operators.load import append, load
from quayside.operators.script import ScriptResult, run_script
from quayside.sources.audit import audit_files, source_verdict
from quayside.sources.dialect import CsvDialect
from quayside.sources.infer import dry_run, infer_schema
from quayside.sources.listing import (
    extract_blob,
    extract_blobs,
    ingest_blobs,
    list_children,
    list_files,
    list_recursive,
)
from quayside.sources.scan import scan_csv, scan_files, scan_parquet, scan_source, zero_rows

__all__ = [
    "CsvDialect",
    "DmlResult",
    "ExportResult",
    "MergeClause",
    "ScriptResult",
    "append",
    "audit_files",
    "delete",
    "dry_run",
    "export",
    "export_json",
    "extract_blob",
    "extract_blobs",
    "infer_schema",
    "ingest_blobs",
    "list_children",
    "list_files",
    "list_recursive",
    "load",
    "merge",
    "run_script",
    "scan_csv",
    "scan_files",
    "scan_parquet",
    "scan_source",
    "source_verdict",
    "update",
    "zero_rows",
]
