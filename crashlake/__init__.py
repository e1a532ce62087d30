"""Crash-report analytics as Spark DataFrame jobs.

Sub-packages
------------
``functions``  Column expressions: versions, times, text, signatures, search filters.
``operators``  DataFrame -> DataFrame jobs: cleaning, duplicates, daily marts, reads.
``sources``    Readers and writers for raw crashes, feeds, marts and extracts.
``streaming``  Structured Streaming forms of the hourly and continuous work.
``plans``      Daily job graph, backfill, and the registry of checked queries.
"""
