"""Data in and out: bronze landing and scans, table files, and the mapping of the generated test
tables onto the domain."""
