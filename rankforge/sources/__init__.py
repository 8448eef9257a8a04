"""rankforge.sources"""
