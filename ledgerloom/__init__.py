"""Load delimited bank data into tables and consolidate complaints, segments and reviews."""
