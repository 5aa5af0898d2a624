"""Where records come from and go to: Kafka, files, the schema registry table."""
