"""``spark-submit`` programs; cluster, storage and jar settings stay with spark-submit."""
