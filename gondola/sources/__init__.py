"""Readers, writers and the views that turn other tables into price records."""
