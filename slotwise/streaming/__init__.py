"""Streaming use.

No operator here keeps state across micro-batches: every dataset of the workload is a finite table.
The row-wise expressions of ``slotwise.functions`` are plain Columns, so they also work on a
streaming DataFrame (``tests/test_functions.py`` runs them on one).
"""
