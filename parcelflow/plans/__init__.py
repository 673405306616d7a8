"""Whole jobs: the layered batch run and the analytical queries on the star."""
