"""Page tables, stored article tables and site profiles."""
