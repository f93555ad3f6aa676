"""Fit/transform stages, training, evaluation and scoring built from the operators."""
