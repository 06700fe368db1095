"""Writers: topics, window store, CSV exports."""
