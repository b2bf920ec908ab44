"""Operators of a training-data pipeline: token counts, quality rules and
classifier, URL and licence filters, HTML text, decontamination, mixing,
exact-substring and near-duplicate removal.  Nothing outside this package
imports it."""
