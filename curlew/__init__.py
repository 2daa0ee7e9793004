"""Curlew: a Spark-first engine for curating research-data metadata at scale."""
