"""Operators of a training-data pipeline. One module per operator; ``queries`` names them over the sample tables."""
