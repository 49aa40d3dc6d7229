"""dockflow.sinks"""
