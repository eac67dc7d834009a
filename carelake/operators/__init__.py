"""DataFrame -> DataFrame operators (shape, filters, lookups, aggregates,
sequences, set operations). ``df`` is always the first argument so that
``df.transform(op, ...)`` composes them."""
