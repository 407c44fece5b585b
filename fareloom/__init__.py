"""Cleaning, analysis, modelling and scoring of trip records as Spark DataFrame functions."""
