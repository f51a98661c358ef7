"""Training-data pipeline operators.

Nothing outside this subpackage imports it.  Each module holds one operator;
``registry`` binds them to the driver's tables.
"""
