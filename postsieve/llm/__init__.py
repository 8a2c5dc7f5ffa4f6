"""Operators for large text corpora: tokens, personal data, language, fingerprints, near copies, search, mixing, pages."""
