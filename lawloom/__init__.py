"""Structured tables from collections of legislative documents, as native Spark plans."""
