from fareloom.sources.readers import (
    file_row_counts,
    get_file_paths,
    list_files,
    load_from_parquet,
    read_deliveries,
    read_lookup_csv,
    read_parquet,
    read_text_lines,
)
from fareloom.sources.schema_checks import conform, is_valid, validate_schema
from fareloom.sources.schemas import (
    FEED_SCHEMAS,
    GREEN_SCHEMA,
    YELLOW_SCHEMA,
    ZONE_SCHEMA,
)
from fareloom.sources.sinks import save_to_parquet, stage

__all__ = [
    "FEED_SCHEMAS",
    "GREEN_SCHEMA",
    "YELLOW_SCHEMA",
    "ZONE_SCHEMA",
    "conform",
    "file_row_counts",
    "get_file_paths",
    "is_valid",
    "list_files",
    "load_from_parquet",
    "read_deliveries",
    "read_lookup_csv",
    "read_parquet",
    "read_text_lines",
    "save_to_parquet",
    "stage",
    "validate_schema",
]
