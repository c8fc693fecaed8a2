"""statuta.operators"""
