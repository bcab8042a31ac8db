"""Consultation analytics on Spark.

DataFrame-in, DataFrame-out operators for longitudinal consultation records:
profiling and validation, cleaning, pseudonymization, window features,
leakage-free splits, distributed learners, exact ranking metrics and
request scoring (batch and Structured Streaming).
"""

__version__ = "0.1.0"
