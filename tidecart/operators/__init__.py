from tidecart.operators import arrival, audit, counting, lookup, membership, merge, paging, pick, routing

__all__ = ["arrival", "audit", "counting", "lookup", "membership", "merge", "paging", "pick", "routing"]
