"""nearframe.plans"""
