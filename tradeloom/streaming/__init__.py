"""Incremental loading: cursors and lookback in batch, and the same on streams."""
