"""Operators over text corpora: de-duplication, filters, mixing, sharding and token files."""
