"""Writers of result tables."""
