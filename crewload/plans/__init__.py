"""crewload.plans"""
