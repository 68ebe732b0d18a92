"""Shared-expense accounting of condominium buildings as PySpark DataFrame jobs."""
