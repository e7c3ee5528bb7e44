"""DataFrame operators: extraction, filtering, clustering, overlap, chunked summaries."""
