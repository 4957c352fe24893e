"""Operators for training-data pipelines: filters, deduplication, tokenising,
formatting, extraction and scoring over document, page and conversation tables."""
