"""Query catalogue: named jobs over the test tables and their independent SQL oracles."""
