"""Catalogue analytics on Spark: cleaning, publishing, features and similarity as DataFrame operators."""
