"""Readers and file selection for report CSVs, page-view JSON, backup logs and consent."""
