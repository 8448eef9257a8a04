"""rankforge.plans"""
