"""Readers.  Each returns a lazy DataFrame with an explicit schema."""
