"""Spark jobs for image-caption training sets: manifests, samples, epochs, losses."""
