"""predia: a Spark-native data engine for a property marketplace.

Raw full loads and change files become curated keyed tables, curated tables become denormalised products,
products become reporting marts. Every operator is a ``DataFrame -> DataFrame`` function built on native
Spark expressions; files are touched only in ``sources`` and ``streaming``.
"""
