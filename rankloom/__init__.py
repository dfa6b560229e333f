"""Text retrieval, reranking, query expansion and ranking evaluation as Spark DataFrame operators."""

__version__ = "0.1.0"
