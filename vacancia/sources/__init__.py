"""Sources: landed payloads to posting records, and the sinks.

Every payload table has the columns of ``RAW_DDL``. A parser takes such a table and returns posting
records; what cannot be read goes to the quarantine table of the same source instead of failing the
job.
"""

RAW_DDL = "seq bigint, site string, fetched_at timestamp, url string, company string, payload string"
