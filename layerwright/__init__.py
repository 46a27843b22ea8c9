"""Layered data-quality and analytics on Spark: landing, cleansing, quality gate, models, evaluation."""
