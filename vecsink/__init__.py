"""Kafka-shaped tables and streams to vector-database objects, on Spark."""
