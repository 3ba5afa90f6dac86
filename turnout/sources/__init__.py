from turnout.sources.files import (
    preview_mart,
    read_current,
    read_marts,
    read_raw_csv,
    read_stage,
    replace_stage,
    stage_versions,
    write_csv,
    write_marts,
    write_stage,
)

__all__ = [
    "preview_mart", "read_current", "read_marts", "read_raw_csv", "read_stage", "replace_stage",
    "stage_versions", "write_csv", "write_marts", "write_stage",
]
