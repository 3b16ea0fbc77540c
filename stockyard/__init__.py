"""Supply-chain analytics as PySpark DataFrame jobs."""
