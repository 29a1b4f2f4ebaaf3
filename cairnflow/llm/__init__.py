"""Training-data operators: search, de-duplication, extraction, scoring, mixing.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports
this subpackage, so it can be removed without touching the rest of the library.
"""
