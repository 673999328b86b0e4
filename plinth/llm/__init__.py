"""Operators for training-data pipelines. Nothing else in plinth imports this subpackage."""
