"""Sources: CSV drops, JSON topics, change feeds and raw tables."""
