"""Operators for preparing training corpora, each ``DataFrame -> DataFrame``."""
