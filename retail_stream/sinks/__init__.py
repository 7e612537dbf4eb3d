"""Topic, archive, table and console outputs."""
