"""The operators bound to the TPC-H-like test tables, each beside its SQL oracle."""
