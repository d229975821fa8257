"""Registered queries by job."""

