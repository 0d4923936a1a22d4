"""turnloom: chat-session logs as Spark tables, from raw records to a verified event log."""
