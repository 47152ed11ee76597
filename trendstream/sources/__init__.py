"""Readers and writers: parquet tables, file/Kafka topics, message files and post searches."""
