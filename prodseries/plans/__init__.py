"""Stages composed into whole pipelines, and the query catalog."""
