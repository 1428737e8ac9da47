"""Layered order analytics written as plain PySpark DataFrame functions."""
