"""Propensity scoring and next-action ranking as Spark DataFrame transformations."""
