"""dockflow.ml"""
