"""Vellum: legacy script archives, text catalogs and corpus preparation on PySpark."""
