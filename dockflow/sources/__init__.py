"""dockflow.sources"""
