"""corpgraph.streaming"""
