"""DataFrame-to-DataFrame operators, meant for ``df.transform(op)`` chains."""
