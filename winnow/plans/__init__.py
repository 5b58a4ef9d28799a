"""winnow.plans"""
