"""statuta.sources"""
