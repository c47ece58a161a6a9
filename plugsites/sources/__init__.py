"""Readers for delimited feeds, landed text and boundary layers."""
