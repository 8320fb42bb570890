"""Readers and writers."""
from .io import (arff_lines, read_arff, read_csv, read_csv_pair, write_csv, write_json,  # noqa: F401
                 write_ordered)
