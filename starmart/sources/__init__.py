"""Sources and sinks: parquet, CSV, label text files, views."""

from starmart.sources.labels import label_dictionary, label_dictionary_pair, label_section, parse_pairs, read_texts
from starmart.sources.readers import scan_csv, scan_csv_delimited, scan_parquet, typed_frame
from starmart.sources.sinks import append_parquet, new_rows, register_view, write_code_csv, write_parquet

__all__ = [
    "label_dictionary", "label_dictionary_pair", "label_section", "parse_pairs", "read_texts",
    "scan_csv", "scan_csv_delimited", "scan_parquet", "typed_frame",
    "append_parquet", "new_rows", "register_view", "write_code_csv", "write_parquet",
]
