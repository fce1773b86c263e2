"""Operators for preparing language-model training data.

One module per operator; ``queries.py`` registers them.  Nothing outside this
folder (but the driver's entry, behind a guard) imports it.
"""
