"""Operators for preparing language-model training corpora (each one module; queries in ``suite.py``)."""
