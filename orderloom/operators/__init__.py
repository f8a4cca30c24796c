"""Reusable DataFrame operators: joins, rollups, quality rules, table writes."""
