"""Catalogue extraction, cleaning, de-duplication and merging as Spark DataFrame jobs."""
