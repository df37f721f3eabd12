"""Maps TPC-H-like tables (``customer nation region orders lineitem part events``) to the shop's tables.

The source tables have no gender, birthday, device or log texts; those are derived by plain formulas so that an
independent SQL engine can derive the same.
"""
