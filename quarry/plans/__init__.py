"""Query catalog, model jobs and end-to-end compositions."""
