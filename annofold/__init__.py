"""Protein-annotation analytics as PySpark DataFrame transformations."""
