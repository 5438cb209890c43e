"""Composite jobs: silver tables, star schema, reports, dashboard, usage."""
