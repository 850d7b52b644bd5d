"""Zone steps, consumer queries and the run orchestration."""
