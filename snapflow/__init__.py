"""Dated-snapshot ingestion and ownership derivations as PySpark DataFrame functions."""
