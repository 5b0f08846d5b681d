"""Operators for preparing training corpora, each over DataFrames of documents, pages or vectors."""
