"""Writers: labelled console, partition-aware, JDBC, Kafka, keyed upsert."""
