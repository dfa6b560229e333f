"""Column functions: text analysis, vectors, annotations and metrics."""
