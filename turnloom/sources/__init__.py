"""Readers: SQLite stores, request-window transcripts, legacy JSONL, stored logs."""
