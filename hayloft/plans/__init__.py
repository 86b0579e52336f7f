"""Composed plans: parsers, silver and gold tables, contracts, checks, KPIs."""
