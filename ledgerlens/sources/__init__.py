"""Reading raw data: relational tables, landed JSON payloads, declared schemas."""
