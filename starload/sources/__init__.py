"""Landed payload documents and interchange CSV files."""
