"""Tidewatch: network-telemetry analytics expressed as Spark DataFrame jobs.

Raw protocol logs become session rows, session rows become tumbling behaviour
windows, and both feed detection rules, an isolation-forest score, findings and
health checks.  Every operator is a function from DataFrame to DataFrame (or a
function that returns a Column); nothing in the core path collects to the driver.
"""
