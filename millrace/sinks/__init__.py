"""Sinks: console, text files, Kafka, bulk documents, fan-out by tag."""
