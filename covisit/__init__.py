"""Interaction analytics and item affinity, expressed as Spark DataFrame plans.

Layers, from the outside in:

``jobs``       command-line jobs: read a table, run a plan, write a table
``plans``      the composite computations (ingest, click window, similarity, graph, reports)
``operators``  reusable DataFrame -> DataFrame steps
``functions``  column expressions (parsing, dates)
``sources``    raw messages, catalog tables, graph tables
``streaming``  the incremental form of ingest

Everything below ``jobs`` is lazy: functions take and return DataFrames, and only the
``sources`` writers, ``streaming`` and ``jobs`` start Spark work.
"""

__version__ = "0.1.0"
