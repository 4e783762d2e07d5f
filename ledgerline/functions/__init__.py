"""Column-level helpers: JSON codecs, identifier sanitising, date/time and numeric expressions."""
