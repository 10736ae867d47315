from .files import cache_then_coalesce, write_bounded, write_csv, write_observed, write_one_record_files, write_orc
from .layout import (
    add_year_month, date_predicates, write_by_value, write_dynamic, write_skew_split, write_table_by_value, year_predicates,
)
from .tables import insert_overwrite

__all__ = [
    "cache_then_coalesce", "write_bounded", "write_csv", "write_observed", "write_one_record_files", "write_orc",
    "add_year_month", "date_predicates", "write_by_value", "write_dynamic", "write_skew_split", "write_table_by_value",
    "year_predicates", "insert_overwrite",
]
