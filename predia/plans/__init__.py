"""Whole jobs: raw to curated, mapped loads, products, reporting marts."""
