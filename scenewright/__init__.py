"""Narrative-document analytics as DataFrame-to-DataFrame operators on PySpark."""
