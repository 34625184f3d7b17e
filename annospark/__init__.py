"""Spark jobs that build, check and analyse labelled video timelines and the model traffic around them."""
