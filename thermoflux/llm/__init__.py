"""Training-data operators: token counts and files, pseudonyms, near-duplicates, search,
quality, packing and byte-pair coding.  Nothing outside this folder, ``tests/llm`` and
``corpus_pipeline.py`` imports it.
"""
