"""Input schemas, readers, catalog tables and the sample-data adapter."""
