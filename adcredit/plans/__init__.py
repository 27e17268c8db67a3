"""Registered queries (with their DuckDB oracle), batch jobs and plan inspection."""
