"""Permit records on Spark: extraction, record upkeep, progress ledger and browsing."""
