"""Driving the loads with the test tables, and checking them with plain SQL."""
