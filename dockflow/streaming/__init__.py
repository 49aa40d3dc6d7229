"""dockflow.streaming"""
