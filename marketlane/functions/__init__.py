"""Scalar rules as functions from Column to Column."""
