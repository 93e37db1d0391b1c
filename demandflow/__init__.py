"""demandflow: retail-demand analytics as plain PySpark DataFrame jobs."""
