"""nearframe.operators"""
