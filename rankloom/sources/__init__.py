"""Readers and writers: corpora, topics, word vectors, triples, reports."""
