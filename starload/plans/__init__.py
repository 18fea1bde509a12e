"""Whole loads: tables, staging, dimensions, fact."""
