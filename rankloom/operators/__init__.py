"""DataFrame-to-DataFrame operators: index, search, rerank, expand, summarise, evaluate, report."""
