"""Table sources and sinks: parquet/CSV reads, appends, id allocation, upserts.

Import from :mod:`faultline.sources.tables`.
"""
