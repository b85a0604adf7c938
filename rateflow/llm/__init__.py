"""Operators for preparing large text corpora (see the README, "Corpus operators").

Nothing outside this subpackage and ``corpus_pipeline.py`` imports it; the
library works without it.
"""
