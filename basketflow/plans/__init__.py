"""Shared facts, feature tables, ML dataset and the end-to-end build."""
