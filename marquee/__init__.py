"""marquee: a Spark-native curation engine for OCR-style event listings.

Layout
------
``functions``  Column -> Column building blocks (text, dates, money, names, places).
``operators``  DataFrame -> DataFrame stages (line grouping, record extraction,
               conforming to dimensions, quality gates, warehouse load).
``sources``    readers / writers and fixed reference data as DataFrames.
``plans``      the registered queries over the driver tables and their SQL oracles.
``streaming``  incremental ingest of newly arrived issue files.
"""

__all__ = ["session"]
