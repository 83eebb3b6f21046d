"""courtframes.sources"""
