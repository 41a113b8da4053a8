"""Document analytics on Spark: layout features, field extraction, entity resolution, similar-document search."""
