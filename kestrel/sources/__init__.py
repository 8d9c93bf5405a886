"""Inputs: driver tables, stand-in views, seeds and landed API files."""
