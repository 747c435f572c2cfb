"""Whole data flows, composed of the operators."""
