"""corpusloom: text-corpus analytics as PySpark DataFrame jobs."""
