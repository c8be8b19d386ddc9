"""corpgraph.functions"""
