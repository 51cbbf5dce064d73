from reviewlens.sources.choose import first_readable
from reviewlens.sources.files import dataset_inventory, file_inventory, json_profile, preview
from reviewlens.sources.reports import read_report
from reviewlens.sources.tables import (
    read_aggregate_lines,
    read_events,
    read_json_pairs,
    read_parquet_dir,
    read_processed,
    read_raw_once,
    read_raw_products,
    read_rating_pairs,
    read_results,
)

__all__ = [
    "dataset_inventory",
    "file_inventory",
    "first_readable",
    "json_profile",
    "preview",
    "read_aggregate_lines",
    "read_events",
    "read_json_pairs",
    "read_parquet_dir",
    "read_processed",
    "read_rating_pairs",
    "read_raw_once",
    "read_raw_products",
    "read_report",
    "read_results",
]
