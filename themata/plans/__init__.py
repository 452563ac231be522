"""Fitted models and experiments."""
