"""A PySpark engine for text-segmentation datasets."""
