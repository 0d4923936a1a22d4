"""Relational operators over sessions, messages, parts and events."""
