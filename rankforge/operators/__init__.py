"""rankforge.operators"""
