"""Readers: tables, incremental files, message topics and misaligned CSV."""
