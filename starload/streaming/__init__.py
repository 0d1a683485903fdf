"""Event-driven forms of two loads."""
