"""Billing feeds in, one open cost-and-usage schema out, checked in one distributed pass."""

__version__ = "0.1.0"
