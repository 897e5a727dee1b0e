"""DataFrame steps: derivation, window tagging, aggregates, report, run log."""
