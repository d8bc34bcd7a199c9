"""Operators: profiling, selection, derivation, targets, features, models,
evaluation, tuning, explanation, scoring and text."""
