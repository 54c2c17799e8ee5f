"""Structured Streaming ingest (file or Kafka source -> bronze) and streaming
silver merged by micro-batch."""
