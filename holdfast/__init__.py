"""A Spark-native engine for archive metadata: selection, readiness, statements, reconciliation and run logs."""
