"""Readers for raw logs, staged days, the clean table and earlier reports."""
