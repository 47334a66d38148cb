from ebbline.sources.raw import RawSchemas, load_raw_data, raw_parse_losses
from ebbline.sources.shared import scratch_path
from ebbline.sources.tables import (
    create_snapshot_once,
    ensure_schema,
    list_schemas,
    list_tables,
    read_snapshot,
    session_info,
    write_report_csv,
    write_report_json,
    write_table,
    write_tables,
)

__all__ = [
    "RawSchemas",
    "create_snapshot_once",
    "ensure_schema",
    "list_schemas",
    "list_tables",
    "load_raw_data",
    "raw_parse_losses",
    "read_snapshot",
    "scratch_path",
    "session_info",
    "write_report_csv",
    "write_report_json",
    "write_table",
    "write_tables",
]
