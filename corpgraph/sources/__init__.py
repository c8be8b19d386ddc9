"""corpgraph.sources"""
