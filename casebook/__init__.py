"""casebook: regulatory incident events as Spark DataFrame jobs.

Raw agency files go in, one row per event comes out, and from those rows the
nation / state / city / company / site summaries and their page documents.
"""
