"""Batch readers, stored tables and generated dimensions."""
