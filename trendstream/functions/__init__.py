"""Column functions: payload codecs, language scorer, entity extraction."""
