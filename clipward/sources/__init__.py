"""Readers, writers and incremental bookkeeping."""
