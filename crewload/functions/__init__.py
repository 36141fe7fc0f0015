"""crewload.functions"""
