"""corpgraph.operators"""
