"""Readers: text, Kafka, sequences, tickers and appended files."""
