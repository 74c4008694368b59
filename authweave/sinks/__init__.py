"""Writers for staged days, the clean table, result tables and reports."""
