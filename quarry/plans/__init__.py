"""Queries bound to the driver tables, one per SURVEY operator ID."""
