"""DataFrame-to-DataFrame operations shared by batch and stream."""
