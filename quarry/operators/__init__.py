"""DataFrame operators that Spark lacks as one call (ring lookup, replay, late flag, ...)."""
