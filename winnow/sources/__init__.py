"""winnow.sources"""
