"""Writers for tables, reports, quarantine and the run log."""
