"""Structured Streaming forms of the upsert, the daily report and the run tracker."""
