"""Training-data operators on documents, pages and embeddings; nothing outside this subpackage imports it."""
