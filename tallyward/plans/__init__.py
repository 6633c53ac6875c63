"""Composite jobs: staging, marts, measures and reports."""
