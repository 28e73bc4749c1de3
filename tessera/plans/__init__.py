"""Composite jobs (what a user calls): reports, clustering, trips."""
