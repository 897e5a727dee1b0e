"""Scans: job exports (files, landing, test-table view) and event logs."""
