"""DataFrame operators: projection, cleaning, upsert, checks and KPI queries."""
