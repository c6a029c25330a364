"""Operators for preparing training data, with their queries and the corpus pipeline's stages."""
