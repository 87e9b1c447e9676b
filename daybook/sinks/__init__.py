"""Warehouse tables that can be re-run safely."""
