"""Job-posting tables on Spark: parse, extract, enrich, de-duplicate, assemble."""
