"""DataFrame-to-DataFrame operators; columns, thresholds and the report time are parameters."""
