"""Cohort genetics analytics expressed as Spark DataFrame transformations."""
