"""Data-audit engine on Spark: contracts, payload detection, profiles, paging, reconciliation, publication."""
