"""dockflow.operators"""
