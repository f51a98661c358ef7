"""DataFrame operators, one module a capability.  All are lazy: none collects."""
