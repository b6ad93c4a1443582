"""lexloom: a Spark-native engine for legal-text analytics, search and corpus preparation."""
