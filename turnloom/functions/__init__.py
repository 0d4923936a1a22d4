"""Column functions: ids, JSON reading, text and time."""
