"""Reading and writing: files, catalogs, schema documents, change-log tables."""
