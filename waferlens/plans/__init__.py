"""Requests and the pipelines that answer them."""
