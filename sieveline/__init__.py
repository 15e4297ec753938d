"""Sieveline: sensitive-text classification and corpus preparation as Spark jobs."""
