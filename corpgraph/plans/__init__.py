"""corpgraph.plans"""
