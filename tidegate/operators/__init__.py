"""Distributed table operators."""
