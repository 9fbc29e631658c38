"""kpiloom: data quality, KPI roll-ups and insights expressed as Spark DataFrame jobs."""
