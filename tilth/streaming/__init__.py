"""Incremental forms: the same jobs fed by files as they land."""
