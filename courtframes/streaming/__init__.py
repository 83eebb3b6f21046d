"""courtframes.streaming"""
