"""courtframes.operators"""
