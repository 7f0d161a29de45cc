"""Writers for the stored tables and for the JSON artifacts."""
