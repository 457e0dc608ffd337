"""Operators that prepare text for language-model training.

Nothing outside this package imports it; ``corpus_pipeline.py`` at the top of
the repository chains five of its operators.
"""
