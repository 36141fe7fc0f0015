"""crewload.operators"""
