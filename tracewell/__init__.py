"""Exposure-membership analytics on Spark: probe strings against line-oriented corpora."""
