"""Readers, table writers and partition look-ups."""
