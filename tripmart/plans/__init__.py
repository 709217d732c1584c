"""Star schema, rollups, reports and the monthly run."""
