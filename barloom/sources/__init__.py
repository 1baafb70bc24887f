"""Readers, record normalisation and keyed tables."""
