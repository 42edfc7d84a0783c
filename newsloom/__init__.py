"""Feed curation as Spark jobs."""
