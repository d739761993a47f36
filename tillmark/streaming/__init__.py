"""The stock guard on arriving order items."""
