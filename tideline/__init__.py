"""Period-record extraction and source-duplication analytics on Spark."""
