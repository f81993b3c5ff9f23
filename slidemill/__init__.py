"""slidemill: image-annotation analytics as PySpark DataFrame programs."""
