"""DataFrame -> DataFrame stages."""
