from reviewlens.sinks.folders import current, replace, write_parts
from reviewlens.sinks.reports import (
    correlation_line,
    report_lines,
    stats_lines,
    write_lines,
)
from reviewlens.sinks.tables import (
    FORMATS,
    delimited,
    export,
    json_ready,
    write_aggregate_lines,
    write_csv,
    write_if_any,
    write_json,
    write_json_or_reject,
    write_parquet,
    write_results,
    write_sample,
    write_tsv,
)

__all__ = [
    "FORMATS",
    "correlation_line",
    "current",
    "delimited",
    "export",
    "json_ready",
    "replace",
    "report_lines",
    "stats_lines",
    "write_aggregate_lines",
    "write_csv",
    "write_if_any",
    "write_json",
    "write_json_or_reject",
    "write_lines",
    "write_parquet",
    "write_parts",
    "write_results",
    "write_sample",
    "write_tsv",
]
