"""hydrapix: water-reflectance raster analytics as Spark plans."""
