from .csv_files import load_csv, schema_diff, typed
from .tables import load_table, shared_folder, write_table, written

__all__ = [
    "load_csv", "load_table", "schema_diff", "shared_folder", "typed", "write_table", "written",
]
