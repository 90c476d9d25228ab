"""Business tables, reports and batch jobs."""
