"""millrace: Spark-native batch ETL operators."""
