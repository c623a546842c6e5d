"""Ledger exports derived from the driver tables, and the SQL that must give the same results."""
