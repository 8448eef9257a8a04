"""rankforge.functions"""
