"""Reusable multi-step dataflow operators (DataFrame -> DataFrame)."""
