"""courtframes.plans"""
