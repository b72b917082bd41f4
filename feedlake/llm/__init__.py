"""Operators for building training data from text and web pages.

Nothing else in the library imports this subpackage.  Each operator has a module;
``queries`` registers one query per operator over the given tables.
"""
