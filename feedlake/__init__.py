"""feedlake: listing feeds in, partitioned tables, documents and reports out, all on Spark."""
