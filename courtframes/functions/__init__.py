"""courtframes.functions"""
