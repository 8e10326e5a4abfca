"""Batch jobs for satellite vegetation analysis on Spark."""
