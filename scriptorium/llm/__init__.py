"""Corpus-scale operators for language-model training data.

Each module holds one operator with its own general interface; ``registry`` holds
the thin queries over the standard tables and their SQL.  Nothing outside this
subpackage imports it.
"""
