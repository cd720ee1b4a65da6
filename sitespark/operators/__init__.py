"""sitespark.operators"""
