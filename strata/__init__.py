"""strata: a Spark-native engine for building, auditing and scoring clustered document collections."""
