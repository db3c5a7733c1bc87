"""Jobs: cleaning of each table, the full refresh, reports and further quality rules."""
