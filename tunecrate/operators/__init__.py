"""DataFrame operators: long-form frames in, long-form frames out."""
