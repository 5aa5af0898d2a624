"""DataFrame-to-DataFrame operators; each works on batches and, where Spark allows it, on streams."""
