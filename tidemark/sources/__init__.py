"""Tables, files, feeds and generators."""
