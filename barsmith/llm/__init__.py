"""Training-data operators: deduplication, tokenizing, mixing, scoring, search.

Nothing else in the package imports this subpackage. Queries are registered
in :mod:`barsmith.llm.queries`; their SQL twins in :mod:`barsmith.llm.oracle`.
"""
