"""Reading, indexing, staging and writing."""
