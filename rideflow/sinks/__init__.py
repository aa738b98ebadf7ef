"""Writers for batch results."""
