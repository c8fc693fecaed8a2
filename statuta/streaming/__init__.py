"""statuta.streaming"""
