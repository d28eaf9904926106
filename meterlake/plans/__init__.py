"""Declarative plans of the silver and gold layers, the queries over them and the models."""
