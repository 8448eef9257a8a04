"""rankforge.operators.models"""
