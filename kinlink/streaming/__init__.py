"""Raw files as they arrive, normalized by the batch operators."""
