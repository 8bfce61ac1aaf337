"""Dataset operators: pure ``DataFrame -> DataFrame`` functions, shared by batch and streaming."""
