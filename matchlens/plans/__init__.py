"""Batch jobs and dashboard queries composed of the operators."""
