"""Model training, scoring, tuning and export on pyspark.ml."""
