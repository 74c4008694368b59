"""Whole runs: test-table adapters, registered queries with their SQL, jobs and reports."""
