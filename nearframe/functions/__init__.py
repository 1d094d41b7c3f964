"""nearframe.functions"""
