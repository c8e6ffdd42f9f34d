"""One module for each registered query: ``query(spark, sf_dir)``, and ``SQL`` where it has any."""
