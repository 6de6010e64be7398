"""Operators for preparing training text, as Spark jobs over tables of documents and vectors."""
