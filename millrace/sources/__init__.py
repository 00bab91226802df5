"""Sources: text lines, collections, Kafka records, tables; batch and stream."""
