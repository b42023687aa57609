from .spec import JoinSpec, Source, SourceSpec, build_source, materialize, union_all
from .tables import (
    row_count,
    scan_catalog,
    scan_files,
    scratch_path,
    target_fields,
    write_files,
    write_table,
)

__all__ = [
    "JoinSpec",
    "Source",
    "SourceSpec",
    "build_source",
    "materialize",
    "row_count",
    "scan_catalog",
    "scan_files",
    "scratch_path",
    "target_fields",
    "union_all",
    "write_files",
    "write_table",
]
