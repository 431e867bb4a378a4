"""ledgerloom: document intelligence and evidence retrieval as Spark DataFrame jobs."""
