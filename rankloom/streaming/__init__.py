"""Growing an index from a stream of documents."""
