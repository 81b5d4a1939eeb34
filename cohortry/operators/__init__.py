"""DataFrame in, DataFrame out. Nothing here collects rows to the driver."""
