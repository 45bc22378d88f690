"""Operators for preparing training text: filters, deduplication, decontamination, classifiers and mixing."""
