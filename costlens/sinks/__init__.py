from costlens.sinks.tables import (
    RunStamp, META_COLS, stamp_run, upsert, append, latest_rows, append_run_log, read_table,
)

__all__ = ["RunStamp", "META_COLS", "stamp_run", "upsert", "append", "latest_rows",
           "append_run_log", "read_table"]
