"""Readers: tables, the derived subscriptions view, lookups, files and documents."""
