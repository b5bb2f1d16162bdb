"""Readers and sinks."""

from ecospark.sources.delimited import (drop_row_range, promote_header, read_csv, read_csv2, read_fread,
                                        read_tsv, with_row_number)
from ecospark.sources.sinks import drop_handoff, handoff, handoff_bucketed, write_csv, write_csv_r, write_table

__all__ = ["drop_row_range", "promote_header", "read_csv", "read_csv2", "read_fread", "read_tsv",
           "with_row_number", "drop_handoff", "handoff", "handoff_bucketed", "write_csv", "write_csv_r", "write_table"]
