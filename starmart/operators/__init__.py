"""Relational operators of the star-schema build, each ``DataFrame -> DataFrame``."""
