"""Whole runs, from parcels, scenes and pixels to series and cubes."""
