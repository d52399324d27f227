"""Chart analytics on Spark: lazy ``DataFrame -> DataFrame`` operators and ready-made datasets."""
