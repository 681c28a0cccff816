"""Health-insurance claims cleansing and analytics, written as Spark DataFrame jobs."""
