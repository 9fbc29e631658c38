"""Declared configuration and the job chains built from operators."""
