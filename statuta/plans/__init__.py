"""statuta.plans"""
