"""Distributed detection models: Spark ML estimators and compositions of them."""
