"""Medallion lakehouse jobs for order, inventory and shipment data on Spark."""
