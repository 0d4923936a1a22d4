"""Whole runs: sync, verify, audit, status, and the command line."""
