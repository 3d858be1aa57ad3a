"""Readers, writers and checks (io), the driver-table binding, the run log."""
