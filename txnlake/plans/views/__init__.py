"""Views by namespace: sales, product, customer, geographic, cancellation,
and operations (adjustment, non_sales, data_quality)."""
