"""Cloud threat-detection findings analytics as PySpark DataFrame jobs."""
