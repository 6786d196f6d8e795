"""Inputs and outputs.

quote_files  quote documents (multi-line JSON) and the newest-file rule
pages        rates read off captured converter pages
config       target lists and fixed currency values
tables       the driver's Parquet tables with explicit schemas
proxies      rate inputs derived from the driver's tables (FIXTURES §3)
sinks        staging, ERP table, CSV export, keyed upsert, MERGE INTO
"""
