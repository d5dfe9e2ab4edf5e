"""Corpus analytics on PySpark: tokens, vectors, models, graphs, pages and document streams as DataFrame operators."""
