"""Operators of a training-data pipeline: formatting, decontamination, archives,
tokenising, near-duplicate search, scoring.

Each module holds one operator with a general interface; ``catalog`` registers
one thin query per operator, and ``corpus_pipeline.py`` at the repository top
chains five of them. Nothing outside this subpackage imports it.
"""
