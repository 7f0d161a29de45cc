"""Compositions: the batch stages and the queries over the driver's tables."""
