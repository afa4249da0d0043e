"""Deskloom: support-message analytics as Spark DataFrame operators."""
