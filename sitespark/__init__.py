"""sitespark: DataFrame-first operators for geospatial site selection on Apache Spark."""
