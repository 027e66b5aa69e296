"""Incremental file-by-file load of the sales fact."""
