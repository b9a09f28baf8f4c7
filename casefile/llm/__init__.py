"""Operators for corpora of text: each module holds one, `queries` applies them to the test tables."""
