"""DataFrame -> DataFrame operators (no storage access here)."""
