"""Readers, row generators and payload flatteners."""
