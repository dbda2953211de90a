"""Retrieval data work on Spark: files to chunks, chunks to vectors, vectors to answers and scores."""
