"""Writers of Bronze batches and of Silver and Gold tables."""
