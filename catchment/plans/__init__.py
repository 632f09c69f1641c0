"""Composite plans: silver/gold models, jobs, audit, registered queries."""
