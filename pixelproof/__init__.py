"""Spark jobs for classifying large image collections as real or generated."""
