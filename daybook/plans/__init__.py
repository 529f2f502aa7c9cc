"""Whole flows made of operators: batch upserts, refreshes, dashboards, and the registered queries."""
