"""Compositions of operators that read and write a warehouse."""
