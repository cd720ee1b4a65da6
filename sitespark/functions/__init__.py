"""sitespark.functions"""
