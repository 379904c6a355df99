"""Analytics over the gold tables, and the runs that build them."""
