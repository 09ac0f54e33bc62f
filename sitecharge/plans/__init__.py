"""Whole pipelines built from the stages."""
