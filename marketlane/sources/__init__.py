"""Readers, domain views over the driver's tables, and writers."""
