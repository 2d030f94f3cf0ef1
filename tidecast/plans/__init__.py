"""End-to-end plans (offline pipeline, requests, scenarios) and the query catalog."""
