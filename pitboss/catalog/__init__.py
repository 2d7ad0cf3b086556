"""Named queries: Spark builders with their independent SQL forms (the correctness check)."""
