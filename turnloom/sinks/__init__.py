"""Writers: event store, registry, reports, lock."""
