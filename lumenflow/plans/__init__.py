"""Job shells and the registered driver queries."""
