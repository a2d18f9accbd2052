"""Training-data operators (deduplication, sharding, token counts, language
identification, packing, embeddings, BPE, quality, HTML extraction, lexical search,
tokenizer alignment) and the stages of the corpus pipeline.

Nothing else in the library imports this subpackage; ``queries.py`` holds the
query functions that the driver contract registers.
"""
