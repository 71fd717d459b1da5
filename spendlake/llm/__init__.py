"""Operators for training-data pipelines at corpus scale, and their registered queries."""
