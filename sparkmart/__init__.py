"""sparkmart: snapshot-keyed data marts and the ML tables on top of them, as Spark jobs.

Every operator is a plain ``DataFrame -> DataFrame`` function built on Spark SQL expressions
or ``pyspark.ml``; nothing pulls data rows to the driver.  Fits (vocabularies, means, modes,
scaler statistics) return small, size-checked results that later transforms use as literals.
"""

__version__ = "0.1.0"
