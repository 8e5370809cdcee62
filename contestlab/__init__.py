"""contestlab package."""
