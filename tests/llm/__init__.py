"""Tests of the corpus operators and their pipeline."""
