"""Incremental application of the row-level operators.

The analyses studied have no streaming part; what carries over is that
every cleaning / labelling / scoring operator is a DataFrame -> DataFrame
function without ordering or state, so it runs unchanged on a file stream.
"""
from .apply import run_incremental  # noqa: F401
