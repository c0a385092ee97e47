"""Sources: landed-file readers, payload parsers, reference tables."""
