"""Spark-first toolkit for preparing, checking, comparing and modelling tables."""
