"""Model data jobs (MLD-*): splits, scaling, metrics, training, scoring and monitoring.

Everything stays a distributed DataFrame; the reference's ``toPandas`` + sklearn/xgboost
steps are re-aimed at Spark aggregates and ``pyspark.ml``.
"""
