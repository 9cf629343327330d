"""Training-data operators: formatting, packing, near-duplicates, scans, filters, sharding, quality rules.

One module per operator.  Every operator takes a DataFrame and column names
and returns a DataFrame; ``queries`` registers one production query per
operator over the generated tables.  Nothing else in the library imports
this subpackage.
"""
