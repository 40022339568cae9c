"""Readers of landed files, versioned tables and the publishing writer."""
