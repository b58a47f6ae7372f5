"""Text contracts in, partitioned tables and text out."""
