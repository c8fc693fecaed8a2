"""statuta.functions"""
