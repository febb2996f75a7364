"""Weirstone: change events to star-schema analytics as Spark DataFrame jobs.

Layers
------
``sources``    change topics, CSV files, table storage, catalogue publication
``functions``  column expressions: lenient parsing, cleaning, exact money sums
``operators``  DataFrame -> DataFrame building blocks (latest image, keys, lookups, gates)
``plans``      one builder per silver/gold table, the reports, the whole pipeline
``streaming``  the incremental (Structured Streaming) form of ingestion
``bindings``   change feeds derived from the star-schema sample tables
"""
