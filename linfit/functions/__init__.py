"""Column-level building blocks: every function here maps columns to a column."""
