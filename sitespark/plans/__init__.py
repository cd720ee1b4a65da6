"""sitespark.plans"""
