"""Readers and writers."""
from .tables import read_table

__all__ = ["read_table"]
