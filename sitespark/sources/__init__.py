"""sitespark.sources"""
