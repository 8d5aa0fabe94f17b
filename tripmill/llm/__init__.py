"""Operators for preparing training data: token files, language, duplicates, packing, scoring."""
