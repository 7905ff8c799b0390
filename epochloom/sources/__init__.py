"""Ledger tables and JSON record files."""
