"""Requests, contracts and the assembled dataset."""
