"""End-to-end flows and the registry of driver queries."""
