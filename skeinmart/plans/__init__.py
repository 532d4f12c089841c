"""Business queries, dashboard tables and the batch pipeline."""
