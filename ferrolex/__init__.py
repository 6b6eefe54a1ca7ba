"""ferrolex: a Spark-first engine that turns extracted materials-literature records into model-ready tables."""

__version__ = "0.1.0"
